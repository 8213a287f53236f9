"""The operators bound to the driver tables: `opN_<name>` queries and their SQL."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from quotelake.llm import (
    bpe, decontaminate, exact_dedup, fill_middle, html_text, language_id, near_dedup, paragraph_dedup, preferences, suffix_dedup, topk, url_filter, vector_codes,
)
from quotelake.llm.shared import ship
from quotelake.plans.catalog import registry

QUERIES, ORACLES = {}, {}

# The vocabulary file that the token queries use.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(name, sql=None):
    def register(plan):
        def run(spark, folder):
            ship(spark)
            return plan(registry.Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


# The rules of the url query.
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


@query(
    "op5_url_filter",
    """
    with rules(rule_host, rule_path, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    parts as (
        select page_id,
            coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
            coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') as path
        from pages),
    judged as (
        select page_id, host, path, list_sort(list({'n': length(rule_host || rule_path), 'h': length(rule_host),
            'rule': rule_host || rule_path, 'verdict': verdict}) filter (rule_host is not null), 'DESC')[1] as best
        from parts left join rules
            on ('.' || host) like ('%.' || rule_host) and starts_with(path, rule_path)
        group by page_id, host, path)
    select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from judged
    """,
)
def op5_url_filter(t):
    rules = t.spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(t.pages, rules)


@query("op6_bpe_words")
def op6_bpe_words(t):
    encoded = bpe.encode_documents(t.documents, VOCABULARY)
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op9_language_id")
def op9_language_id(t):
    docs = t.documents.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    model = language_id.fit(docs.where("not coalesce(held_out, false)"))
    return docs.withColumn("found", language_id.identify(docs, model)).select(
        "doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
    )


@query(
    "op7_top_k",
    """
    with v as (
        select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as vector
        from embeddings
        where embedding is not null and vec_id is not null
            and list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    scored as (
        select q.vec_id as query_id, c.vec_id as vec_id,
            cast(list_sum(list_transform(range(1, len(c.vector) + 1), lambda i: q.vector[i] * c.vector[i])) as bigint) as score
        from (select vec_id, min(vector) as vector from v where vec_id % 100 = 0 group by vec_id) as q
            join v as c on q.vec_id <> c.vec_id and len(q.vector) = len(c.vector)),
    ranked as (
        select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
    select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
)
def op7_top_k(t):
    return topk.top_k(t.embeddings, t.embeddings.where("vec_id % 100 = 0"), k=10)


@query("op8_html_text")
def op8_html_text(t):
    return html_text.extract_pages(t.pages).withColumn("n_chars", F.length("text").cast("bigint"))


def _rejected(conversations):
    """Each conversation with its last answer taken from its neighbour (ids 2k and 2k + 1); the
    turn goes if the neighbour has no answer."""
    answers = conversations.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("own"))
    swapped = answers.select(F.expr("conv_id ^ 1").alias("conv_id"), F.col("own.text").alias("other"))
    last = answers.join(swapped, "conv_id", "left").select("conv_id", F.col("own.turn").alias("last"), "other")
    is_last = F.coalesce((F.col("role") == "assistant") & (F.col("turn") == F.col("last")), F.lit(False))
    return (
        conversations.join(last, "conv_id", "left")
        .where(~is_last | F.col("other").isNotNull())
        .select("conv_id", "turn", "role", F.when(is_last, F.col("other")).otherwise(F.col("text")).alias("text"))
    )


@query(
    "op4_preference_pairs",
    """
    with answers as (
        select conv_id, max(turn) as turn, arg_max(text, turn) as text from conversations where role = 'assistant' group by conv_id),
    other as (
        select c.conv_id, c.turn, c.role, case when l.conv_id is null then c.text else p.text end as text
        from conversations as c
        left join answers as l on l.conv_id = c.conv_id and l.turn = c.turn and c.role = 'assistant'
        left join answers as p on p.conv_id = xor(c.conv_id, 1)
        where l.conv_id is null or p.text is not null),
    a as (select conv_id, role, text, row_number() over (partition by conv_id order by turn, role, text) as pos from conversations),
    b as (select conv_id, role, text, row_number() over (partition by conv_id order by turn, role, text) as pos from other),
    cut as (
        select conv_id, count(a.role) as n, min(case when a.role is distinct from b.role or a.text is distinct from b.text
            then pos end) as first from a full join b using (conv_id, pos) group by conv_id having count(b.role) > 0 and count(a.role) > 0),
    shared as (select conv_id, coalesce(first - 1, n) as n from cut),
    turns as (
        select 0 as side, conv_id, pos, role, text from a union all select 1, conv_id, pos, role, text from b),
    heads as (
        select side, conv_id, pos, role, n, '<|im_start|>' || role || chr(10) as head, text || '<|im_end|>' || chr(10) as tail
        from turns join shared using (conv_id)),
    spans as (
        select *, cast(coalesce(sum(length(head) + length(tail)) over (partition by side, conv_id, pos > n order by pos
            rows between unbounded preceding and 1 preceding), 0) as bigint) + length(head) as start from heads),
    parts as (
        select side, conv_id, any_value(n) as n, coalesce(string_agg(head || tail, '' order by pos) filter (pos <= n), '') as prompt,
            coalesce(string_agg(head || tail, '' order by pos) filter (pos > n), '') as completion,
            coalesce(string_agg(start || '-' || (start + length(tail)), ',' order by pos)
                filter (pos > n and role = 'assistant'), '') as mask
        from spans group by side, conv_id)
    select a.conv_id, cast(a.n as integer) as shared_turns, a.prompt as prompt, a.completion as chosen, a.mask as chosen_mask,
        b.completion as rejected, b.mask as rejected_mask
    from parts as a join parts as b on a.conv_id = b.conv_id and a.side = 0 and b.side = 1
    """,
)
def op4_preference_pairs(t):
    pairs = preferences.format_pairs(t.conversations, _rejected(t.conversations), key="conv_id")
    spans = {
        c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
        for c in ("chosen_mask", "rejected_mask")
    }
    return pairs.withColumns(spans)


@query("op1_suffix_dedup")
def op1_suffix_dedup(t):
    cut = suffix_dedup.remove_repeats(t.documents, length=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_near_duplicates")
def op3_near_duplicates(t):
    return near_dedup.near_duplicates(t.documents)


@query("op2_paragraph_dedup")
def op2_paragraph_dedup(t):
    cut = paragraph_dedup.remove_passages(t.documents)
    return cut.select("doc_id", "n_chars", "n_removed", "n_spans", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query("op10_decontaminate")
def op10_decontaminate(t):
    return decontaminate.contaminated(t.documents, t.benchmark)


@query(
    "op13_exact_dedup",
    """
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
        row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
        sha256(coalesce(text, '')) as text_sha256
    from documents window same as (partition by coalesce(text, ''))
    """,
)
def op13_exact_dedup(t):
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    found = exact_dedup.exact_groups(t.documents, {"digest": digest})
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query(
    "op12_fill_middle",
    """
    with drawn as (
        select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
            list_transform(range(0, 4), lambda g: list_reduce(list_prepend(cast(0 as bigint), list_transform(range(1, 9), lambda i:
                cast(instr('0123456789abcdef', substr(sha256('1:' || coalesce(cast(doc_id as varchar), '')), 8 * g + i, 1)) - 1
                    as bigint))), lambda a, d: 16 * a + d)) as h
        from documents),
    cut as (
        select *, cast(len(units) as bigint) as n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as a,
            greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as b,
            case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 90
                then 'plain' when h[4] % 100 < 20 then 'spm' else 'psm' end as form
        from drawn),
    parts as (
        select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle,
            array_to_string(units[b + 1:n], '') as suffix from cut)
    select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
        case when form <> 'plain' then length(middle) end as middle_chars,
        sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
        sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256
    from parts
    """,
)
def op12_fill_middle(t):
    made = fill_middle.fill_in_middle(t.documents)
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return fill_middle.restore(made, kept).drop("restored")


def _code_sql(rounds=vector_codes.ROUNDS):
    """The rounds written out: parts, codebook `c<i>` and the entry `b<i>` that is nearest to each part."""
    assign = """
    b{i} as materialized (
        select rid, p, min({{'d': d, 'e': entry}}) as best from (
            select rid, p, entry, cast(coalesce(list_sum(list_transform(range(1, len(k.part) + 1),
                lambda i: (k.part[i] - c.part[i]) * (k.part[i] - c.part[i]))), 0) as bigint) as d
            from parts as k join c{i} as c using (p))
        group by rid, p),"""
    step = """
    s{i} as (
        select p, entry, list((total - ((total % n) + n) % n) // n order by place) as part from (
            select p, best.e as entry, place, sum(part[place]) as total, count(*) as n
            from (select rid, p, part, unnest(range(1, len(part) + 1)) as place from parts) join b{i} using (rid, p)
            group by all)
        group by p, entry),
    c{j} as materialized (
        select p, entry, coalesce(s.part, c.part) as part from c{i} as c left join s{i} as s using (p, entry)),"""
    middle = "".join((assign + step).format(i=i, j=i + 1) for i in range(rounds)) + assign.format(i=rounds)
    return f"""
    with kept as materialized (
        select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as rid,
            list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as vector
        from embeddings
        where embedding is not null and list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    parts as materialized (
        select rid, p, vector[p * (len(vector) // 4) + 1:(p + 1) * (len(vector) // 4)] as part
        from (select rid, vector, unnest(range(0, 4)) as p from kept)),
    c0 as (select p, rid - 1 as entry, part from parts where rid <= 256),{middle}
    coded as (
        select vec_id, label, string_agg(lower(printf('%02x', best.e)), '' order by p) as code, cast(sum(best.d) as bigint) as error
        from b{rounds} join kept using (rid) group by rid, vec_id, label),
    books as (
        select sha256(string_agg(array_to_string(part, ','), ',' order by p, entry)) as codebooks_sha256 from c{rounds})
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
    from coded, books
    """


@query("op11_vector_codes", _code_sql())
def op11_vector_codes(t):
    coded, codebooks = vector_codes.compress(t.embeddings)
    digest = F.lit(codebooks.sha256()).alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", digest)
