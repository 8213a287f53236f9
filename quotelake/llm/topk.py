"""Exact top-k by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are dealt into blocks, and each block of queries meets each block of candidates once. In
a pair of blocks the candidates are sorted by every dimension; a query goes down all lists at
once, scores what it meets, and stops when even a vector with the best remaining value in every
dimension could not enter its top k. The k best of all blocks are then ranked together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.shared import finite

SCALE = 1024
#: Scaled components up to here are whole numbers of 64 bits.
MOST = 1 << 62
FOUND_SCHEMA = "query_id bigint, vec_id bigint, score bigint"


def _highest(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Order of the rows by falling score, equal ones by id; scores may be wide integers."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), int)
    return np.lexsort((ids, -scores))


def threshold_top_k(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows with the highest inner product, ties to the smaller id.

    `order` has for each dimension the places of the rows by ascending value.
    """
    n, used = len(rows), np.flatnonzero(query)
    weights = query[used]
    rising = weights > 0
    seen = np.zeros(n, bool)
    best, scores = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
    low, high = 0, 4 * k
    while True:
        high = min(high, n)
        # The next places of every list: from its end where large values score high.
        met = np.zeros(n, bool)
        met[order[used[rising], n - high : n - low]] = True
        met[order[used[~rising], low:high]] = True
        fresh = np.flatnonzero(met & ~seen) if len(used) else np.arange(n)
        seen[fresh] = True
        best = np.concatenate([best, fresh])
        scores = np.concatenate([scores, rows[fresh] @ query])
        keep = _highest(scores, ids[best])[:k]
        best, scores = best[keep], scores[keep]
        if high == n or not len(used) or seen.all():
            return best
        last = np.where(rising, order[used, n - high], order[used, high - 1])
        bound = (weights * rows[last, used]).sum()
        # An unseen row can reach the bound but not pass it; at equal scores its id may be smaller.
        if len(best) == k and scores[-1] > bound:
            return best
        low, high = high, 4 * high


def _search(k: int):
    def run(key, queries: pa.Table, candidates: pa.Table):
        dim = key[2].as_py()

        def matrix(table):
            flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(table.num_rows, dim).astype(np.int64), table.column("vec_id").to_numpy()

        (wanted, query_ids), (rows, ids) = matrix(queries), matrix(candidates)
        out = [np.zeros((3, 0), np.int64)]
        if len(wanted) and len(rows):
            largest = int(np.abs(wanted).max(initial=0)) * int(np.abs(rows).max(initial=0)) * dim
            # Floats hold such sums exactly, and multiply faster; sums beyond 64 bits are made of wide integers.
            kind = np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 63 else object
            exact, order = rows.astype(kind), np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T)
            for query_id, query in zip(query_ids, wanted.astype(kind), strict=True):
                # One more for the query itself, and as many as share its id.
                own = int((ids == query_id).sum())
                top = threshold_top_k(query, exact, ids, order, k + own)
                top = top[ids[top] != query_id][:k]
                score = (exact[top] @ query).astype(np.int64)  # fails where a score found has more than 64 bits
                out.append(np.stack([np.full(len(top), query_id), ids[top], score]))
        found = np.concatenate(out, axis=1)
        return pa.table([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, query_rows: int = 8192, block_rows: int = 16384) -> DataFrame:
    """`query_id, rank, vec_id, score` of the `k` best rows of `vectors` for each query.

    Both have `vec_id, embedding`. A component x counts as floor(1024 x); the score is the integer
    inner product. Candidates are all rows of the same dimension but those with the query's id; equal
    scores go to the smaller id. Rows with a null id, or with a vector that is null or holds a null or
    non-finite component, take no part. Repeated candidates are separate rows; of queries that share an id
    the smallest vector is taken. Scores are exact; one of the k best that has more than 64 bits, or a
    scaled component of more than 62, ends the job with an error. Other columns are not read.
    """

    def scaled(df):
        ready = df.where("vec_id is not null").where(finite(F.col("embedding")))
        wide = F.exists("embedding", lambda x: F.abs(x.cast("double") * SCALE) >= MOST)
        error = F.raise_error(F.lit("a scaled component has more than 62 bits")).cast("array<bigint>")
        whole = F.when(wide, error).otherwise(F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint")))
        return ready.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("vector"))

    candidates = scaled(vectors)
    wanted = scaled(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, math.ceil(vectors.count() / block_rows))
    query_blocks = max(1, math.ceil(queries.count() / query_rows))

    def dealt(df, own, count, other, other_count):
        return (
            df.withColumn(own, F.pmod(F.xxhash64("vec_id", "vector"), F.lit(count)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))))
            .withColumn("dim", F.size("vector"))
        )

    keys = ["query_block", "block", "dim"]
    left = dealt(wanted, "query_block", query_blocks, "block", blocks)
    right = dealt(candidates, "block", blocks, "query_block", query_blocks)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), FOUND_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
