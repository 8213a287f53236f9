"""Url rules, exact search, preference pairs and the pipeline; every query with SQL against DuckDB."""

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelake.llm import preferences, topk, url_filter
from quotelake.llm.catalog import ORACLES, QUERIES
from tests.oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, QUERIES[name], ORACLES[name]) is None


# --- urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.org", "/x", "block"), ("a.org", "/x", "allow"), ("bare", "", "block"), (None, "/", "block"), ("x", None, "block")]


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    best = None
    for rule_host, rule_path, verdict in rules:
        if rule_host is None or rule_path is None or not path.startswith(rule_path):
            continue
        if host == rule_host or host.endswith("." + rule_host):
            found = (len(rule_host + rule_path), len(rule_host), verdict == "block", rule_host + rule_path, verdict)
            best = max(best, found) if best else found
    return host, path, best and best[3], best[4] if best else "allow"


def test_urls(spark):
    rng = random.Random(3)
    hosts = ["example.net", "EXAMPLE.net", "www.Example.Com", "example.com", "a.org", "b.a.org", "xa.org", "net", "x.net.", "bare", "anet", "ÄNET", "u:p@a.org", "net:80", ""]
    tails = ["", "/", "/en/", "/en", "/de/1.html", "/fr/?a=/en/", "#/x", "?q=://net/", "/x/y", "/EN/", "/en//", "/\n/fr/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{t}" for h in hosts for t in tails]
    urls += [None, "", "no scheme net/", "http:/net/", "mailto:a@net", "a://b://net/"]
    pages = frame(spark, [(i, u, "h", "r") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    got = url_filter.judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: judged(u, RULES) for i, u in enumerate(urls)}


def test_url_edge_rows(spark):
    schema = "page_id bigint, url string"
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    twice = url_filter.judge_urls(frame(spark, [(1, "http://net/")] * 2 + [(None, "http://net/")], schema), rules).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in twice) == [(0, "block"), (1, "block"), (1, "block")]
    assert url_filter.judge_urls(frame(spark, [], schema), rules).collect() == []
    none = url_filter.judge_urls(frame(spark, [(1, "http://net/")], schema), rules.limit(0)).collect()
    assert [(r.rule, r.verdict) for r in none] == [(None, "allow")]


@pytest.mark.parametrize("listed, size", [(1, 1), (3, 3000), (400, 3000), (3000, 3000), (2500, 3000), (0, 50)])
def test_cascade_is_exact_over_its_universe(spark, listed, size):
    universe = spark.range(size).select(F.concat(F.lit("key"), "id").alias("key"))
    keys = universe.where(f"cast(substring(key, 4) as int) < {listed}").unionByName(universe.limit(0))
    cascade = url_filter.build_cascade(keys.union(keys), universe)
    assert universe.where(cascade.has(F.col("key"))).count() == listed
    assert {r.key for r in universe.where(cascade.has(F.col("key"))).collect()} == {r.key for r in keys.collect()}
    assert sum(level.bits for level in cascade.levels) <= 64 * len(cascade.levels) + 40 * max(listed, 1)


def test_a_list_that_is_too_long_for_a_plan(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_BITS", 64)
    keys = spark.range(200).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(ValueError, match="do not go into a plan"):
        url_filter.build_cascade(keys.limit(100), keys)


def test_url_plan_has_no_python_and_no_join(spark):
    plan = QUERIES["op5_url_filter"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


# --- search


def brute_top(rows, queries, k):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, []).append([int(np.floor(1024 * float(np.float32(x)))) for x in v])
    out = []
    for q in queries:
        if q in whole:
            vector = min(whole[q])
            scored = sorted(
                (-sum(a * b for a, b in zip(vector, v, strict=True)), i) for i, vs in whole.items() for v in vs if i != q and len(v) == len(vector)
            )
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("dims, values", [(8, None), (24, None), (3, [0.0, 0.5, -0.5]), (0, None)])
def test_top_k(spark, dims, values):
    rng = random.Random(dims)
    rows = [(i, [rng.choice(values) if values else rng.gauss(0, 1) for _ in range(dims)]) for i in range(300)]
    rows += [(i, list(rows[0][1])) for i in range(300, 360)]
    vectors = frame(spark, [(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, rank int, score string", 4)
    got = topk.top_k(vectors, vectors.where("vec_id % 10 = 0"), k=7, query_rows=9, block_rows=70)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, range(0, 360, 10), 7)


def test_top_k_edge_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [3.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (None, [9.0, 9.0]), (6, [1.0, 2.0, 3.0]), (7, []), (8, [-0.0004, 0.0])]
    vectors = frame(spark, rows, "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(vectors, vectors, k=10).collect())
    assert got == brute_top(rows, range(9), 10)
    empty = vectors.limit(0)
    assert topk.top_k(empty, empty).collect() == topk.top_k(vectors, empty).collect() == []


def test_top_k_of_large_components(spark):
    """Scores need 64 bits or, on the way to them, more; none is dropped."""
    rng = random.Random(40)
    rows = [(i, [rng.choice([1, -1]) * rng.choice([0.5, 3.0, 70_000.0, 80_000.0, 250_000.0]) for _ in range(6)]) for i in range(60)]
    rows += [(100, [2.0**20, 0.0, 0.0, 0.0, 0.0, 0.0]), (101, [0.0, 2.0**45, 0.0, 0.0, 0.0, 1.0])]
    vectors = frame(spark, rows, "vec_id bigint, embedding array<float>")
    wanted = [*range(0, 60, 3), 100]
    got = topk.top_k(vectors.where("vec_id < 101"), vectors.where(F.col("vec_id").isin(wanted)), k=8)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows[:-1], wanted, 8)
    got = topk.top_k(vectors, vectors.where("vec_id = 100"), k=5)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, [100], 5)
    with pytest.raises(Exception, match="62 bits"):
        topk.top_k(frame(spark, [(1, [1e20]), (2, [1.0])], "vec_id bigint, embedding array<float>"), vectors).collect()


def test_threshold_stops_early():
    """The first lists already hold the best rows, so most of the others are never met."""
    rows = np.zeros((4000, 6), np.int64)
    rows[:, 0] = np.arange(4000)
    rows[:, 1:] = np.arange(4000)[:, None] % 7
    order = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T)
    met = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            met.append(len(np.atleast_1d(at)) if not isinstance(at, tuple) else 0)
            return np.asarray(self)[at]

    top = topk.threshold_top_k(np.array([1000, 1, 0, 0, 0, 0]), rows.view(Watched), np.arange(4000), order, 5)
    assert top.tolist() == [3999, 3998, 3997, 3996, 3995] and sum(met) < 1000


# --- preference pairs


def brute_pair(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1

    def render(turns):
        text, spans = "", []
        for role, words in turns:
            text += f"<|im_start|>{role}\n"
            if role == "assistant":
                spans.append((len(text), len(text) + len(words) + len("<|im_end|>\n")))
            text += words + "<|im_end|>\n"
        return text, spans

    return n, render(a[:n])[0], *render(a[n:]), *render(b[n:])


def test_preference_pairs(spark):
    rng = random.Random(8)
    sides, expected = ([], []), {}
    for pair in range(60):
        a = [(rng.choice(["user", "assistant", "system"]), rng.choice(["hi", "é😀", "", "no\nway"])) for _ in range(rng.randint(1, 7))]
        b = a[: rng.randint(0, len(a))] + [("assistant", rng.choice(["hi", "other"])) for _ in range(rng.randint(0, 2))]
        for side, turns in zip(sides, (a, b), strict=True):
            side += [(pair, 10 * i, role, text, "x", 0) for i, (role, text) in enumerate(turns)]
        if b:
            expected[pair] = brute_pair(a, b)
    schema = "pair_id bigint, turn bigint, role string, text string, prompt string, side int"
    got = preferences.format_pairs(*(frame(spark, s, schema) for s in sides)).collect()
    assert {r.pair_id: (r.shared_turns, r.prompt, r.chosen, [tuple(s) for s in r.chosen_mask], r.rejected, [tuple(s) for s in r.rejected_mask])
            for r in got} == expected


def test_preference_edge_rows(spark):
    schema = "pair_id bigint, turn bigint, role string, text string"
    chosen = [(1, 0, "user", None), (1, 1, None, "a"), (1, None, "system", "s"), (None, 0, "user", "x"), (2, 0, "user", "x"), (3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    rejected = [(1, 0, "user", ""), (1, 1, "", "b"), (1, None, "system", "s"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    got = {r.pair_id: r for r in preferences.format_pairs(frame(spark, chosen, schema), frame(spark, rejected, schema)).collect()}
    assert got.keys() == {1, 3}
    assert (got[1].shared_turns, got[1].chosen, got[1].rejected) == (2, "<|im_start|>\na<|im_end|>\n", "<|im_start|>\nb<|im_end|>\n")
    assert got[1].prompt == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert (got[3].shared_turns, got[3].rejected, got[3].chosen_mask) == (2, "", [])
    empty = frame(spark, [], schema)
    assert preferences.format_pairs(empty, frame(spark, chosen, schema)).collect() == []


# --- pipeline


def test_pipeline(spark):
    from quotelake.llm.decontaminate import contaminated
    from quotelake.llm.near_dedup import near_duplicates
    from quotelake.llm.paragraph_dedup import remove_passages
    from tests.llm.test_text import encoded

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    docs = docs.unionByName(spark.createDataFrame([(900, None, "en", "s", 0), (901, "12 !", "en", "s", 4), (None, "the and of", None, "s", 10)], docs.schema))
    after = {}
    for (name, stage), before in zip(corpus_pipeline.STAGES, [None, *range(4)], strict=True):
        source = docs if before is None else after[before]
        after[len(after)] = corpus_pipeline.stored(stage(spark, source, SMALL), "test-stage")
    assert all(after[i].columns == columns for i in range(4))
    ids = [Counter(r.doc_id for r in after[i].select("doc_id").collect()) for i in range(5)]
    assert ids[0] == Counter(r.doc_id for r in docs.collect()) - Counter([900, 901])
    assert after[0].where("lang is null").count() == 0
    classes = {r.class_id for r in near_duplicates(after[0]).collect()}
    assert {i for i in ids[1] if i is not None} == {c for c in classes if c is not None} and max(ids[1].values()) == 1
    cut = {r.doc_id: r.kept for r in remove_passages(after[1]).collect()}
    assert {r.doc_id: r.text for r in after[2].collect()} == {i: t for i, t in cut.items() if t.strip()}
    assert all(r.n_chars == len(r.text) for r in after[2].collect())
    leaked = {r.doc_id for r in contaminated(after[2], spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert set(ids[3]) == set(ids[2]) - leaked and leaked
    texts = {r.doc_id: r.text for r in after[3].collect()}
    for r in after[4].collect():
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == encoded(texts[r.doc_id])
    assert ids[4] == ids[3]


def test_languages_that_were_not_learned_go(spark):
    rng = random.Random(31)

    def letters(alphabet):
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(3, 9))) for _ in range(40))

    strange = [
        "Широкая электрификация южных губерний даст мощный толчок подъёму сельского хозяйства.",
        "Árvíztűrő tükörfúrógép, és a magyar nyelv szépségei közé tartozik a hosszú szavak használata.",
        "これは日本語の文章です。今日は天気がいいので散歩に行きましょう。",
        letters("bcdfghjklmnpqrstvwxz"), letters("abcdefghijklmnopqrstuvwxyz"),
    ]
    clean = ["the and of", "Hello", "The cat sat on the mat.", "This work is licensed under the GNU General Public License, version 3."]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    planted = [(900 + i, text, None, "s", len(text)) for i, text in enumerate([*strange, *clean])]
    got = corpus_pipeline.keep_languages(spark, docs.unionByName(spark.createDataFrame(planted, docs.schema)), SMALL).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()} | {905, 906, 907, 908}
    assert all(r.lang for r in got)


def test_pipeline_stages_keep_columns_of_any_name(spark):
    """Null and repeated ids, and columns named as what the stages make on the way."""
    rng = random.Random(33)
    sentence = lambda n: " ".join(rng.choice(["the", "and", "of", "house", "river", "stone", "walks", "green"]) for _ in range(n))
    long = sentence(60)
    texts = [long, sentence(30) + "\n" + long + "\n" + sentence(20), sentence(50), sentence(50), sentence(12), long, None, ""]
    rows = [(None if i % 2 else i // 4, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    extra = ["_found", "found", "_row", "row", "tie", "_tie", "_copy", "copy", "_leaks", "_removed", "removed", "passages", "unit", "root", "bucket"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in extra)
    docs = frame(spark, [(*r, *(f"{c}-{i}" for c in extra)) for i, r in enumerate(rows)], schema, 3)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), "test-stage")
        found = docs.collect()
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        for r in found:
            assert len({r[c].rsplit("-", 1)[1] for c in extra}) == 1 and all(r[c].startswith(c) for c in extra)
    numbers = Counter(int(r["_found"].rsplit("-", 1)[1]) for r in found)
    assert max(numbers.values()) == 1 and {2, 3, 4} <= set(numbers) and not {6, 7} & set(numbers)
    assert sum(long in r.text for r in found) == 1


def test_pipeline_of_an_empty_table(spark):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SMALL)
        assert out.collect() == []
