"""Byte-string, paragraph and document deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quotelake.llm import near, near_dedup, paragraph_dedup, rank_rounds, suffix_dedup
from quotelake.llm.grams import shingles, word_hashes

WORD = re.compile(r"[^\W_]+")


def frame(spark, rows, schema="doc_id bigint, text string", parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def words_of(rng, n, alphabet=400):
    return " ".join(f"w{rng.randrange(alphabet)}x" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


def gram_counts(text):
    words = WORD.findall((text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def roots(count, linked):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


# --- byte strings


def brute_cut(rows, length):
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                mark[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, m in zip(data, mark, strict=True) if not m)
        runs = len(re.findall(rb"\x01+", bytes(mark)))
        out.append((doc_id, len(data), sum(mark), runs, kept))
    return sorted(out)


def spark_cut(df, length):
    got = suffix_dedup.remove_repeats(df, length).collect()
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got)


@pytest.mark.parametrize("length, parts", [(100, 1), (100, 6), (81, 3), (128, 2)])
def test_byte_strings(spark, length, parts):
    rng = random.Random(length + parts)
    base = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(50, 900))) for _ in range(20)]
    rows = []
    for i in range(80):
        pieces = []
        for _ in range(rng.randint(1, 5)):
            b = rng.choice(base)
            at = rng.randrange(len(b))
            pieces.append(b[at : at + rng.randint(20, 400)])
            if rng.random() < 0.4:
                pieces.append("".join(rng.choice("xyzw") for _ in range(rng.randint(1, 60))))
        rows.append((i, "".join(pieces)))
    rows += [(100, "a" * 1000), (101, "a" * 99), (102, "ab" * 300), (103, None), (104, ""), (105, "a" * 100)]
    rows += [(106, "abc" * 200 + "ab" * 200), (107, base[0] * 2), (108, "z" * (suffix_dedup.RUN_BYTES + 50))]
    assert spark_cut(frame(spark, rows, parts=parts), length) == brute_cut(rows, length)


def test_byte_strings_of_a_shared_line(spark):
    """A line that many documents share, shorter and longer than the threshold, between different texts."""
    rng = random.Random(5)
    short, long = words_of(rng, 9), words_of(rng, 40)
    rows = [(i, f"{words_of(rng, 8)} {short if i % 2 else long} {words_of(rng, 8)}") for i in range(120)]
    assert spark_cut(frame(spark, rows, parts=8), 100) == brute_cut(rows, 100)


def test_byte_strings_edge_rows(spark):
    text = words_of(random.Random(1), 60)
    schema = "doc_id bigint, text string, tie string, start int, ranges int"
    rows = [(None, text, "x", 1, 1), (7, text, "x", 1, 1), (7, text, "y", 2, 2), (7, None, None, None, None)]
    got = suffix_dedup.remove_repeats(frame(spark, rows, schema), 100).collect()
    removed = sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in got)
    # The null id comes first and keeps its text; the rows that repeat id 7 are one document, and both are cut.
    assert removed == [(False, 0, 0), (False, len(text), len(text)), (False, len(text), len(text)), (True, len(text), 0)]
    assert suffix_dedup.remove_repeats(frame(spark, [], "doc_id bigint, text string")).collect() == []
    alone = suffix_dedup.remove_repeats(frame(spark, [(7, text), (7, text)])).collect()
    assert [(r.n_removed, r.n_spans, r.spans) for r in alone] == [(0, 0, [])] * 2


@pytest.mark.parametrize("length, parts", [(100, 3), (8, 1), (37, 2)])
def test_rounds_of_ranks_give_the_same(spark, length, parts):
    rng = random.Random(length)
    base = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(5, 300))) for _ in range(8)]
    rows = [(i, "".join(rng.choice(base) for _ in range(rng.randint(0, 4)))) for i in range(25)] + [(30, None), (31, "ab" * 150)]
    got = rank_rounds.remove_repeats_by_ranks(frame(spark, rows, parts=parts), length).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_cut(rows, length)


def test_byte_strings_of_null_ids_whose_hashes_collide(spark):
    """Two texts with the same 32-bit hash and no id are still two documents."""
    from pyspark.sql import functions as F

    shared = words_of(random.Random(12), 30)[:160]
    made = spark.range(400_000).select(F.concat(F.lit(shared), F.col("id").cast("string")).alias("text"))
    pairs = made.groupBy(F.hash("text").alias("h")).agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a < b")
    first, second = pairs.orderBy("h").select("a", "b").first()
    got = suffix_dedup.remove_repeats(frame(spark, [(None, first), (None, second)])).collect()
    assert sorted(r.n_removed for r in got)[0] == 0 and sorted(r.n_removed for r in got)[1] >= 160


def test_names_agree_only_for_equal_strings():
    data = np.frombuffer(("abcdefgh" * 30 + "abcdefgx").encode(), np.uint8)
    found = suffix_dedup.names(data, 64)
    for m, values in found.items():
        strings = [bytes(data[i : i + m]) for i in range(len(data) - m + 1)]
        assert len(set(strings)) == len({(s, v) for s, v in zip(strings, values.tolist(), strict=False)}) == len(
            set(values[: len(strings)].tolist())
        )


# --- paragraphs


def test_paragraphs(spark):
    rng = random.Random(2)
    pool = [words_of(rng, rng.randint(30, 90)) for _ in range(12)]
    rows = []
    for i in range(90):
        lines = [edited(rng, rng.choice(pool), rng.choice([0, 0, 0.01, 0.02, 0.05, 0.2])) for _ in range(rng.randint(1, 4))]
        rows.append((i, "\n".join(["a short line", *lines, "", words_of(rng, 50)])))
    units = [(d, k, gram_counts(line).keys()) for d, t in rows for k, line in enumerate(t.split("\n")) if len(line.split()) >= 40]
    linked = [
        (a, b) for a in range(len(units)) for b in range(a)
        if len(units[a][2] & units[b][2]) >= 0.8 * len(units[a][2] | units[b][2])
    ]
    gone = defaultdict(set)
    for i, root in enumerate(roots(len(units), linked)):
        if i != root:
            gone[units[i][0]].add(units[i][1])
    expected = {}
    for d, t in rows:
        kept = "\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone[d])
        expected[d] = (len(t), len(t) - len(kept), kept)
    got = paragraph_dedup.remove_paragraphs(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_chars, r.n_removed, r.kept) for r in got} == expected
    assert sum(map(len, gone.values())) > 60
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) <= r.n_removed and len(r.spans) == r.n_spans


def query_cut(spark, tmp_path, rows):
    """What `op2_paragraph_dedup` gives for documents: the id, the characters removed, the digest of the rest."""
    from quotelake.llm.catalog import QUERIES

    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return {r.doc_id: (r.n_removed, r.kept_sha256) for r in QUERIES["op2_paragraph_dedup"](spark, str(tmp_path)).collect()}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_a_wrapped_passage_of_the_query(spark, tmp_path):
    """A repeated passage of 72 words with 12 words to a line; a line without a shingle stays."""
    rng = random.Random(21)
    passage = "\n".join(words_of(rng, 12, 5000) for _ in range(6))
    rows = [(i, f"{words_of(rng, 60, 5000)}\n{passage}\na short line\n{words_of(rng, 9, 5000)}") for i in range(5)]
    got = query_cut(spark, tmp_path, rows)
    assert got[0] == (0, digest(rows[0][1]))
    for i, text in rows[1:]:
        assert got[i] == (len(passage) + 1, digest(text.replace(passage + "\n", "")))


def test_passages_inside_lines_of_the_query(spark, tmp_path):
    """Passages between differing text, on one line and wrapped in other ways: all but 15 words at either end go."""
    rng = random.Random(22)
    passages = [words_of(rng, n, 10**6).split() for n in (51, 70, 200)]
    rows, spans = [], {}
    for i in range(12):
        before, passage, after = words_of(rng, 30, 10**6).split(), passages[i % 3], words_of(rng, 30, 10**6).split()
        words, width = before + passage + after, (10**6, 12, 10, 17)[i // 3]
        rows.append((i, "\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width))))
        spans[i] = (before, passage, after)
    got = {r.doc_id: r for r in paragraph_dedup.remove_passages(frame(spark, rows)).collect()}
    for i, text in rows:
        before, passage, after = spans[i]
        kept = got[i].kept.split()
        stay = len(kept) - len(before) - len(after)
        # Equal texts choose equal windows, so what stays of a passage is the same in each copy.
        assert kept[: len(before)] == before and kept[len(before) + stay :] == after
        assert stay == len(passage) if i < 3 else stay <= min(30, len(passage) - 36)
        assert got[i].n_removed == len(text) - len(got[i].kept) == sum(s.stop - s.start for s in got[i].spans)
    assert query_cut(spark, tmp_path, rows) == {i: (r.n_removed, digest(r.kept)) for i, r in got.items()}


def test_chosen_windows_and_cuts():
    rng = random.Random(23)
    texts = [words_of(rng, n, 9) for n in (0, 20, 36, 40, 51, 52, 300)] + ["a " * 80, "İx Σ " * 40]
    step, width = paragraph_dedup.STEP, paragraph_dedup.WINDOW
    together = paragraph_dedup.chosen_windows(*word_hashes(texts))
    starts, found = word_hashes(texts)[1], []
    for text, begin in zip(texts, starts, strict=False):
        words, own = word_hashes([text])
        at, names = paragraph_dedup.chosen_windows(words, own)
        assert np.all(np.diff(at) <= step) and (len(at) > 0) == (len(words) >= width)
        if len(at):
            assert at[0] < step and len(words) - width - at[-1] < step
        found += zip((at + begin).tolist(), names.tolist(), strict=True)
    assert found == list(zip(*(x.tolist() for x in together), strict=True))
    assert paragraph_dedup.cut_passages("one two three, four\nfive six\nseven", [], [(1, 3)]) == ("one , four\nfive six\nseven", [{"start": 4, "stop": 13}])
    assert paragraph_dedup.cut_passages("one two\nthree four\nfive", [], [(1, 3)])[0] == "one four\nfive"
    assert paragraph_dedup.cut_passages("one two\nthree\nfour five", [1], [(1, 3)])[0] == "one \nfour five"
    assert paragraph_dedup.cut_passages("İİ x\nİ y", [], [(0, 0 + len(word_hashes(["İİ"])[0]))])[0] == "x\nİ y"


def brute_passages(rows, least=40, shortest=5, window=36, step=16):
    """What `remove_passages` leaves, by comparing all paragraphs, lines and windows."""
    units, lone = [], []
    for d, text in rows:
        lines = [WORD.findall(line.lower()) for line in text.split("\n")]
        run = []
        for k, words in enumerate([*lines, []]):
            if 0 < len(words) < least:
                run.append(k)
                continue
            if len(run) > 1 and sum(len(lines[i]) for i in run) >= least:
                units.append((d, run[0], len(run), [w for i in run for w in lines[i]]))
            run = []
            if words:
                units.append((d, k, 1, words))
        lone += [(d, k, 1, words) for k, words in enumerate(lines) if shortest <= len(words) < least]
    sets = [gram_counts(" ".join(u[3])).keys() for u in units]
    linked = [(a, b) for a in range(len(units)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    groups = defaultdict(list)
    for i, root in enumerate(roots(len(units), linked)):
        groups[root].append(units[i][:3] + (len(units[i][3]),))
    for u in lone:
        groups[tuple(u[3])].append(u[:3] + (len(u[3]),))
    gone = defaultdict(dict)
    for members in groups.values():
        for d, first, lines, words in sorted(members)[1:]:
            for k in range(first, first + lines):
                gone[d][k] = gone[d].get(k, 0) + (words if k == first else 0)
    kept_lines = {}
    for d, found in gone.items():
        runs = []
        for k in sorted(found):
            if not runs or k > runs[-1][-1] + 1:
                runs.append([])
            runs[-1].append(k)
        kept_lines[d] = {k for run in runs if sum(found[k] for k in run) >= least for k in run}
    seen, out = {}, {}
    for d, text in rows:
        words, starts = word_hashes([text])
        plain = WORD.findall(text.lower())
        passages = []
        for i in paragraph_dedup.chosen_windows(words, starts)[0].tolist():
            key = tuple(plain[i : i + window])
            if key not in seen:
                seen[key] = (d, i)
            else:
                begin = max(i, seen[key][1] + window) if seen[key][0] == d else i
                if begin < i + window:
                    passages.append((begin, i + window))
        out[d] = paragraph_dedup.cut_passages(text, sorted(kept_lines.get(d, ())), passages)[0]
    return out


def test_the_query_against_all_pairs(spark):
    """Lines, blocks, runs of shorter lines and windows of the given documents, compared one by one."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id").collect()]
    got = {r.doc_id: r.kept or "" for r in paragraph_dedup.remove_passages(docs).collect()}
    assert got == brute_passages(rows)
    assert sum(got[d] != t for d, t in rows) > 10


def test_blocks_and_lone_lines(spark):
    rng = random.Random(77)
    slogan = "thanks for reading this article"
    block = [words_of(rng, 14, 10**6).split() for _ in range(6)]
    rows = [(i, f"{words_of(rng, 50, 10**6)}\n{slogan}") for i in range(30)]
    for i in range(30, 36):
        words = [list(line) for line in block]
        words[i % 6][rng.randrange(14)] = f"e{i}"  # an edited copy in each document
        rows.append((i, f"{words_of(rng, 45, 10**6)}\n" + "\n".join(map(" ".join, words)) + f"\n\n{words_of(rng, 12, 10**6)}"))
    got = {r.doc_id: r.kept for r in paragraph_dedup.remove_passages(frame(spark, rows)).collect()}
    assert got == brute_passages(rows)
    # A slogan in every document stays; of an edited block only the first copy does.
    assert all(got[i] == dict(rows)[i] for i in range(31)) and all(len(got[i].split()) == 57 for i in range(31, 36))


def test_passages_of_a_very_long_text(spark):
    rng = random.Random(78)
    lines = [words_of(rng, rng.choice([8, 20, 60, 300]), 10**6) for _ in range(900)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([words_of(rng, 50), *lines[400:430], words_of(rng, 50)])), (3, "short")]
    assert len(rows[0][1]) > 2 * paragraph_dedup.RUN_CHARS // 4
    got = {r.doc_id: r.kept for r in paragraph_dedup.remove_passages(frame(spark, rows)).collect()}
    assert got == brute_passages(rows)


def test_texts_are_cut_into_words_twice(spark, monkeypatch):
    """Once for paragraphs and once for windows; sets are made of documents that hold a candidate only."""
    rng = random.Random(31)
    copied = words_of(rng, 60, 5000)
    near_copy = {3: copied, 7: copied + "y"}
    rows = [(i, "\n".join([words_of(rng, 50, 5000), near_copy.get(i) or words_of(rng, 45, 5000)])) for i in range(30)]
    docs, read = frame(spark, rows), []
    call = type(docs).mapInArrow

    def spy(df, *more, **named):
        if "text" in df.columns:
            read.append(df.count())
        return call(df, *more, **named)

    monkeypatch.setattr(type(docs), "mapInArrow", spy)
    found = paragraph_dedup._repeated(docs, 0.8, paragraph_dedup.LEAST_WORDS).collect()
    assert sorted(read)[-2:] == [30, 30] and sorted(read)[:-2] == [2]
    assert [[tuple(p) for p in r.removed] for r in found] == [[(1, 1, 60)]]


def test_settled_lines():
    settle = paragraph_dedup.settled_lines
    assert settle([(0, 1, 45)], 40) == [0] and settle([(0, 1, 12)], 40) == []
    assert settle([(2, 1, 20), (1, 1, 20), (4, 1, 39)], 40) == [1, 2]
    assert settle([(3, 4, 50), (5, 1, 9), (8, 1, 12)], 40) == [3, 4, 5, 6]
    assert settle([(3, 1, 8), (4, 2, 41), (6, 1, 8)], 40) == [3, 4, 5, 6] and settle([], 40) == []


def test_paragraph_edge_rows(spark):
    line = words_of(random.Random(3), 45)
    schema = "doc_id bigint, text string, unit string, row int, paragraph int, n_chars int, _removed int"
    rows = [(None, line, "", 0, 0, 1, 1), (1, line, "", 0, 0, 1, 1), (1, line, "", 0, 0, 1, 1), (2, None, "", 0, 0, 1, 1),
            (3, "", "", 0, 0, 1, 1), (4, f"own\n{line}\n\n{line}", "", 0, 0, 1, 1)]
    docs = frame(spark, rows, schema)
    got = sorted(((r.doc_id or 0), r.kept) for r in paragraph_dedup.remove_paragraphs(docs).collect() if r.kept is not None)
    assert got == [(0, line), (1, ""), (1, ""), (3, ""), (4, "own\n")]
    trimmed = paragraph_dedup.trim_documents(docs)
    assert trimmed.columns == docs.columns and {r._removed for r in trimmed.collect()} == {1}
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in trimmed.collect() if r.text) == [(0, line, 1), (4, "own\n", 4)]
    assert {r.text for r in trimmed.collect()} == {line, "own\n", "", None}
    assert paragraph_dedup.remove_paragraphs(frame(spark, [], "doc_id bigint, text string")).collect() == []


# --- documents


def near_rows(seed=4):
    rng = random.Random(seed)
    rows = []
    for family in range(12):
        base = words_of(rng, rng.choice([3, 8, 40, 150, 400]), 3000)
        for copy in range(rng.randint(1, 12)):
            rows.append((len(rows), edited(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.08])) if copy else base))
    rows += [(500, "one two three"), (501, "One, two; THREE!"), (502, "***"), (503, "***"), (504, "+++"), (505, ""), (506, "")]
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    grams = [gram_counts(t) for _, t in rows]
    linked = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if rows[a][1] == rows[b][1] or (grams[a] and grams[b] and weighted_jaccard(grams[a], grams[b]) >= 0.8)
    ]
    expected = {rows[i][0]: rows[r][0] for i, r in enumerate(roots(len(rows), linked))}
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == expected
    sizes = Counter(expected.values())
    assert all(r.class_size == sizes[r.class_id] for r in got)
    assert len(linked) > 50


def test_near_duplicates_of_one_large_family(spark):
    """Copies of one text at all distances: a hub alone would not link them all."""
    rng = random.Random(9)
    base = words_of(rng, 120, 5000)
    rows = [(i, edited(rng, base, rng.random() * 0.06)) for i in range(150)]
    grams = [gram_counts(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if weighted_jaccard(grams[a], grams[b]) >= 0.8]
    got = near_dedup.near_duplicates(frame(spark, rows, parts=7)).collect()
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(roots(len(rows), linked)))


def test_pairs_of_one_large_family(spark, monkeypatch):
    """Variants of one text that are too far from it for a link, with edits that recur, do not all meet each other."""
    rng = random.Random(21)
    base = words_of(rng, 120, 5000).split(" ")

    def variant(edits, letter):
        at = {place: f"{letter}{rng.randrange(3)}" for place in rng.sample(range(5, 115, 5), edits)}
        return " ".join(at.get(i, word) for i, word in enumerate(base))

    rows = [(i, variant(1, "f") if i % 2 else variant(3, "e")) for i in range(200)]
    checked, verify = [], near.verified_links
    monkeypatch.setattr(near, "verified_links", lambda pairs, *more: checked.append(pairs.count()) or verify(pairs, *more))
    grams = [gram_counts(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if weighted_jaccard(grams[a], grams[b]) >= 0.8]
    expected = roots(len(rows), linked)
    assert 20 < len(set(expected)) < 100
    got = near_dedup.near_duplicates(frame(spark, rows, parts=7)).collect()
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(expected))
    assert checked[1] < 5 * len(rows)


def test_near_duplicate_edge_rows(spark):
    text = words_of(random.Random(6), 30)
    schema = "doc_id bigint, text string, unit int, row int, root string, bands int"
    rows = [(None, text, 0, 0, "", 0), (5, text, 0, 0, "", 0), (5, text, 0, 0, "", 0), (4, text + " x", 0, 0, "", 0),
            (8, None, 0, 0, "", 0), (9, None, 0, 0, "", 0), (None, "lone words here", 0, 0, "", 0)]
    docs = frame(spark, rows, schema)
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in near_dedup.near_duplicates(docs).collect())
    assert got == Counter({(None, 4, 4): 1, (5, 4, 4): 2, (4, 4, 4): 1, (8, 8, 1): 1, (9, 9, 1): 1, (None, None, 1): 1})
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({4: 1, 8: 1, 9: 1, None: 1})
    repeated = near_dedup.drop_near_duplicates(frame(spark, [(1, text)] * 3)).collect()
    assert [(r.doc_id, r.text) for r in repeated] == [(1, text)]
    empty = frame(spark, [], "doc_id bigint, text string")
    assert near_dedup.near_duplicates(empty).collect() == near_dedup.drop_near_duplicates(empty).collect() == []


def test_dart_signatures_estimate_the_similarity():
    rng = random.Random(11)
    base = words_of(rng, 600, 10**6)
    for share in (0.01, 0.03, 0.1):
        texts = [base, edited(rng, base, share)]
        exact = weighted_jaccard(*map(gram_counts, texts))
        grams, starts = shingles(*word_hashes(texts))
        signatures, bits = near_dedup.dart_signatures(grams, starts)
        agree = (signatures[0] == signatures[1]).mean()
        assert abs(agree - exact) < 0.2
        differ = sum(int(x).bit_count() for x in bits[0] ^ bits[1])
        if exact >= 0.8:
            assert differ <= near_dedup.MOST_BITS


def test_components_of_a_long_chain(spark):
    links = [(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"\xf0", b"\xf5"), (b"\xf5", b"\xf3"), (b"\xf5", b"\xf5")]
    got = near.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    expected = {bytes([i]): b"\0" for i in range(1, 61)} | {b"\xf5": b"\xf0", b"\xf3": b"\xf0"}
    assert {bytes(r.unit): bytes(r.root) for r in got if r.unit != r.root} == expected


def test_stars_take_no_round(spark, monkeypatch):
    written = []
    for name in ("stored", "checkpointed"):
        write = getattr(near, name, None)
        monkeypatch.setattr(near, name, lambda df, at, write=write: written.append(at) or write(df, at), raising=False)
    star = spark.createDataFrame([(bytes([i]), b"\0") for i in range(1, 9)] + [(b"\xf5", b"\xf0")], "a binary, b binary")
    assert {(bytes(r.unit), bytes(r.root)) for r in near.components(star).collect()} == {
        *((bytes([i]), b"\0") for i in range(1, 9)), (b"\xf5", b"\xf0")
    }
    assert written == ["edges"]
    assert near.components(star.where("a = b")).collect() == []


def test_kept_digest_of_the_query(spark):
    from quotelake.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted(tuple(r) for r in QUERIES["op1_suffix_dedup"](spark, folder).collect())
    assert got == [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute_cut(rows, 100)]
