"""Vector codes against plain distances to all entries."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from quotelake.llm import vector_codes
from quotelake.llm.catalog import ORACLES, QUERIES
from tests.oracle_check import compare, connect


def brute(vectors, rounds=4):
    """Codes and errors of whole-number vectors in id order, and all final components."""
    w = len(vectors[0]) // 4
    cut = lambda v: [v[p * w : (p + 1) * w] for p in range(4)]
    books = [[list(cut(v)[p]) for v in vectors[:256]] for p in range(4)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            held = {}
            for v in vectors:
                held.setdefault(nearest(p, cut(v)[p])[1], []).append(cut(v)[p])
            for i, parts in held.items():
                books[p][i] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    found = [[nearest(p, part) for p, part in enumerate(cut(v))] for v in vectors]
    codes = [("".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for f in found]
    return codes, [x for b in books for e in b for x in e]


@pytest.mark.parametrize("kind", [np.float64, np.int64, object])
def test_nearest_entry_by_masks(kind):
    rng = np.random.default_rng(3)
    for count, width, spread in [(1, 3, 5), (64, 2, 4), (65, 5, 40), (256, 16, 300), (256, 16, 3), (7, 0, 1)]:
        entries = rng.integers(-spread, spread + 1, (count, width)).astype(kind)
        rows = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (150, width)).astype(kind), entries[:20]])
        codes, errors = vector_codes.Slices(entries).nearest(rows)
        for row, code, error in zip(rows, codes, errors, strict=True):
            want = min((sum(int(a - b) ** 2 for a, b in zip(row, e, strict=True)), i) for i, e in enumerate(entries))
            assert (error, code) == want


def test_masks_leave_few_candidates():
    rng = np.random.default_rng(4)
    entries, rows = rng.integers(-500, 500, (256, 4)), rng.integers(-500, 500, (1000, 4))
    near = vector_codes.Slices(entries).candidates(rows, np.full(1000, 100))
    assert np.array_equal(near, (np.abs(rows[:, None] - entries).max(axis=2) <= 100)) and near.mean() < 0.02


def rows_of(rng, n, dim, scale):
    return [(i, [rng.choice([-1, 1]) * rng.random() * scale for _ in range(dim)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("n, dim, scale, parts", [(400, 8, 1, 3), (3, 4, 1, 2), (300, 4, 0.01, 1), (280, 8, 1e6, 3), (40, 4, 1e5, 2), (60, 4, 3e3, 2)])
def test_codes(spark, n, dim, scale, parts):
    rng = random.Random(n)
    rows = rows_of(rng, n, dim, scale)
    rng.shuffle(rows)
    bad = [(-1, None, 1), (-2, [0.0] * (dim - 1) + [math.nan], 1), (-3, [None] + [0.0] * (dim - 1), 1), (-4, [math.inf] * dim, None)]
    bad += [(n + 5, [0.0] * (dim + 1), 2)]  # finite, but not of the common length
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + bad], "vec_id bigint, embedding array<double>, label int, code string, _key string")
    coded, books = vector_codes.compress(df.repartition(parts))
    rows.sort()
    whole = [[math.floor(1024 * x) for x in v] for _, v, _ in rows]
    codes, components = brute(whole)
    sums = Counter()
    for (_, _, label), (_, error) in zip(rows, codes, strict=True):
        sums[label] += error
    want = [(i, label, code, error, sums[label]) for (i, _, label), (code, error) in zip(rows, codes, strict=True)]
    want.append((n + 5, 2, None, None, sums.get(2)))
    got = sorted(tuple(r) for r in coded.select("vec_id", "label", "code", "error", "label_error").collect())
    assert got == want
    assert books.sha256() == hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()


def test_repeated_and_null_ids(spark):
    rows = [(None, [9.0] * 4, None), (1, [2.0] * 4, 1), (1, [1.0] * 4, 1), (1, [1.0] * 4, 1), (0, [3.0] * 4, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    coded, books = vector_codes.compress(df, rounds=0)
    assert [int(e[0]) // 1024 for e in books.parts[0]] == [3, 1, 1, 2, 9]
    got = sorted(map(str, (tuple(r) for r in coded.select("vec_id", "code", "error", "label_error").collect())))
    assert got == sorted(map(str, [(0, "00" * 4, 0, 0), (1, "01" * 4, 0, 0), (1, "01" * 4, 0, 0), (1, "03" * 4, 0, 0), (None, "04" * 4, 0, 0)]))


def test_lengths_that_cannot_be_cut(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    coded, books = vector_codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1), (2, [1.0] * 6, 1), (3, [1.0] * 4, 1)], schema))
    assert books.parts == [] and {tuple(r)[1:] for r in coded.select("vec_id", "code", "error").collect()} == {(None, None)}
    coded, books = vector_codes.compress(spark.createDataFrame([(1, [], 1), (2, [], None)], schema))
    assert {r.code for r in coded.collect()} == {"00000000"}
    coded, books = vector_codes.compress(spark.createDataFrame([], schema))
    assert coded.count() == 0 and books.parts == []
    with pytest.raises(Exception, match="62 bits"):
        vector_codes.compress(spark.createDataFrame([(1, [1e20] * 4, 1)], schema))


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, connect(folder), folder, QUERIES["op11_vector_codes"], ORACLES["op11_vector_codes"]) is None
