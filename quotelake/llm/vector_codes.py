"""Vectors compressed to the indexes of their nearest codebook entries, part by part.

The nearest entry is found by slicing and intersecting: a codebook sorts its entries by every
coordinate and keeps, for each place of that order, a bitmask of the entries before it. The
entries within a radius of a value are then the difference of two such masks, and those within
the radius in all coordinates the AND over the coordinates. Only these candidates are measured;
if one of them lies within the radius, the nearest entry is among them, and if none does, the
radius grows to a distance at which an entry is known to lie.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.shared import finite, stored
from quotelake.operators.windows import with_group_stats

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Scaled components up to here are whole numbers of 64 bits whose sums the rounds can carry.
MOST = 1 << 62
#: Components up to SMALL in at most WIDEST dimensions have squared distances that floats hold exactly;
#: up to NARROW, distances of 64 bits; beyond, they are measured in wide integers.
SMALL, NARROW, WIDEST = 1 << 20, 1 << 26, 256
SUM_SCHEMA = "part int, entry int, place int, high bigint, low bigint, rows bigint"
CODE_SCHEMA = "code string, error bigint"
_root = np.frompyfunc(math.isqrt, 1, 1)


def _roots(squares: np.ndarray) -> np.ndarray:
    """Whole numbers above the square roots."""
    return _root(squares) + 1 if squares.dtype == object else np.sqrt(squares).astype(squares.dtype) + 1


class Slices:
    """The entries of one codebook, sorted by each coordinate, with masks of the entries before each place."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.values = [entries[order[:, j], j] for j in range(width)]
        words = -(-count // 64)
        one = np.zeros((count, words), np.uint64)
        one[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (np.arange(count) % 64).astype(np.uint64)
        start = np.zeros((1, words), np.uint64)
        self.before = [np.concatenate([start, np.bitwise_or.accumulate(one[order[:, j]])]) for j in range(width)]
        self.all = np.bitwise_or.reduce(one)
        spread = [int(v[-1]) - int(v[0]) for v in self.values]
        self.widest = int(np.argmax(spread)) if width else 0
        self.order = order
        self.norms = (entries * entries).sum(axis=1) if width else np.zeros(count, entries.dtype)

    def candidates(self, rows: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row and entry, whether the entry lies within the row's radius in every coordinate."""
        masks = np.tile(self.all, (len(rows), 1))
        for j, (values, before) in enumerate(zip(self.values, self.before, strict=True)):
            first = np.searchsorted(values, rows[:, j] - radius, "left")
            last = np.searchsorted(values, rows[:, j] + radius, "right")
            masks &= before[last] ^ before[first]
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        return bits[:, : len(self.entries)].astype(bool)

    def distances(self, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        gap = rows - self.entries[entries]
        if gap.dtype == object:
            return (gap * gap).sum(axis=1) if gap.shape[1] else np.zeros(len(gap), object)
        return np.einsum("ij,ij->i", gap, gap)

    def _best(self, rows: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows that have candidates, their nearest one (the lowest of equal ones) and its distance."""
        near = self.candidates(rows, radius)
        if rows.dtype == np.float64:
            # Most entries are candidates where a part has many dimensions; one product measures them all.
            squares = (rows * rows).sum(axis=1)[:, None] + self.norms - 2 * (rows @ self.entries.T)
            squares[~near] = np.inf
            entry = squares.argmin(axis=1)
            held = np.flatnonzero(near.any(axis=1))
            return held, entry[held], squares[held, entry[held]]
        at, entry = np.nonzero(near)
        squares = self.distances(rows[at], entry)
        held, begin, counts = np.unique(at, return_index=True, return_counts=True)
        if not len(held):
            return held, held, squares
        least = np.minimum.reduceat(squares, begin)
        hits = np.flatnonzero(squares == np.repeat(least, counts))
        first = hits[np.searchsorted(hits, begin)]
        return held, entry[first], least

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, equal distances to the lower one, and the squared distance."""
        if self.entries.shape[1]:
            place = np.searchsorted(self.values[self.widest], rows[:, self.widest])
            pilot = self.order[np.minimum(place, len(self.entries) - 1), self.widest]
        else:
            pilot = np.zeros(len(rows), np.int64)
        sure = _roots(self.distances(rows, pilot))
        found, error = np.zeros(len(rows), np.int64), np.zeros(len(rows), rows.dtype)
        open_rows, radius = np.arange(len(rows)), sure // 2
        while len(open_rows):
            held, entry, squares = self._best(rows[open_rows], radius)
            inside = squares <= radius[held] * radius[held]
            settled = held[inside]
            found[open_rows[settled]], error[open_rows[settled]] = entry[inside], squares[inside]
            open_rows = np.delete(open_rows, settled)
            radius = sure[open_rows]
        return found, error


def _kind(values: np.ndarray, width: int) -> type:
    """The numbers in which distances are exact: floats, whole numbers of 64 bits, or wide ones."""
    largest = np.abs(values).max(initial=0)
    return object if largest >= NARROW or width > WIDEST else np.int64 if largest >= SMALL else np.float64


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dim)


def _assigned(codebooks: list[np.ndarray]) -> Callable[[np.ndarray], Iterator[tuple]]:
    """A function that assigns rows, some at a time: the rows, and codes and errors by part."""
    width, slices = codebooks[0].shape[1], {}
    least = _kind(np.concatenate([c.ravel() for c in codebooks]), width)
    kinds = [np.float64, np.int64, object]
    step = max(64, (1 << 22) // (ENTRIES * max(1, width)))

    def run(rows: np.ndarray):
        kind = max(least, _kind(rows, width), key=kinds.index)
        if kind not in slices:
            slices[kind] = [Slices(c.astype(kind)) for c in codebooks]
        for begin in range(0, len(rows), step):
            own = rows[begin : begin + step].astype(kind)
            yield own, [s.nearest(own[:, p * width : (p + 1) * width]) for p, s in enumerate(slices[kind])]

    return run


def _sums(codebooks):
    """What a task adds to each entry: componentwise sums, in two halves that Spark can add up, and rows."""

    def run(batches):
        assign, width, dim = _assigned(codebooks.value), codebooks.value[0].shape[1], PARTS * codebooks.value[0].shape[1]
        sums = np.zeros((PARTS, len(codebooks.value[0]), width), object)
        rows = np.zeros(sums.shape[:2], np.int64)
        for batch in batches:
            for own, found in assign(_matrix(batch.column(0), dim)):
                for p, (codes, _) in enumerate(found):
                    part = np.zeros(sums.shape[1:], own.dtype)
                    np.add.at(part, codes, own[:, p * width : (p + 1) * width])
                    sums[p] += part if own.dtype == object else part.astype(np.int64).astype(object)
                    rows[p] += np.bincount(codes, minlength=sums.shape[1])
        for p, entry in np.argwhere(rows):
            total = sums[p, entry]
            yield pa.RecordBatch.from_arrays([
                pa.array([p] * width, pa.int32()), pa.array([entry] * width, pa.int32()), pa.array(range(width), pa.int32()),
                pa.array([int(t) >> 32 for t in total], pa.int64()), pa.array([int(t) & 0xFFFFFFFF for t in total], pa.int64()),
                pa.array([int(rows[p, entry])] * width, pa.int64()),
            ], ["part", "entry", "place", "high", "low", "rows"])

    return run


def _codes(codebooks, columns: list[str]):
    def run(batches):
        assign, dim = _assigned(codebooks.value), PARTS * codebooks.value[0].shape[1]
        for batch in batches:
            codes, errors = [], []
            for own, found in assign(_matrix(batch.column("vector"), dim)):
                digits = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
                codes += [row.tobytes().hex() for row in digits]
                total = [int(t) for t in sum(f[1] if own.dtype == np.float64 else f[1].astype(object) for f in found)]
                if max(total, default=0) >= 1 << 63:
                    raise OverflowError("a squared error has more than 63 bits; scale the vectors down")
                errors += total
            held = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*held, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], [*columns, "code", "error"])

    return run


@dataclass(frozen=True)
class Codebooks:
    """The entries of each part, as whole numbers; none where no vector could be cut."""

    parts: list[np.ndarray]

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for c in self.parts for x in c.ravel().tolist()).encode()).hexdigest()


def _scaled(vectors: DataFrame) -> DataFrame:
    """`vec_id, label, vector` of the kept rows: components as whole numbers."""
    scaled = lambda x: F.floor(x.cast("double") * SCALE)
    wide = F.exists("embedding", lambda x: F.abs(x.cast("double") * SCALE) >= MOST)
    whole = F.when(wide, F.raise_error(F.lit("a scaled component has more than 62 bits")).cast("array<bigint>"))
    kept = vectors.where(finite(F.col("embedding")))
    return kept.select("vec_id", "label", whole.otherwise(F.transform("embedding", scaled)).alias("vector"))


def train(rows: DataFrame, dim: int, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of the vectors of dimension `dim` in `rows` (`vec_id, vector`).

    What comes to the driver is the codebooks and, for each round, one sum for each of their
    components: `ENTRIES` times `dim` numbers, whatever the number of rows.
    """
    spark, width = rows.sparkSession, dim // PARTS
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vector").collect()
    start = np.array([r.vector for r in first], np.int64).reshape(len(first), dim)
    parts = [start[:, p * width : (p + 1) * width] for p in range(PARTS)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(parts)
        added = rows.select("vector").mapInArrow(_sums(sent), SUM_SCHEMA).groupBy("part", "entry", "place")
        totals = added.agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("rows").alias("rows")).collect()
        parts = [c.copy() for c in parts]
        for t in totals:
            parts[t.part][t.entry, t.place] = ((t.high << 32) + t.low) // t.rows
        sent.unpersist()
    return Codebooks(parts)


def _uncoded(rows: DataFrame) -> DataFrame:
    nothing = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")]
    return rows.select("vec_id", "label", *nothing)


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """`vec_id, label, code, error, label_error` for the kept rows of `vectors` (`vec_id, embedding, label`),
    and the codebooks.

    Rows whose vector is null or holds a null or non-finite component are left out. The 256 rows with
    the smallest ids start the codebooks, null ids last, equal ids by their vectors; repeated rows count
    as often as they occur. Parts need vectors of one length that is a multiple of four: the length most
    kept rows have (the larger of equally frequent ones). Rows of another length, or all if that
    length is none, are returned with a null code and error. `label_error` is the sum of the errors
    of all rows with that label, null labels together, and NULL if none has one. A scaled component
    of more than 62 bits, or an error of more than 63, ends the job with an error, as no exact result
    could be returned. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = stored(_scaled(vectors), "scaled_vectors")
    sizes = kept.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim"))
    top = sizes.head()
    dim = top.dim if top and top.dim % PARTS == 0 else None
    if dim is None:
        coded, books = _uncoded(kept), Codebooks([])
    else:
        fits = F.size("vector") == dim
        books = train(kept.where(fits).select("vec_id", "vector"), dim, rounds)
        kinds = ", ".join(f"{c} {t}" for c, t in kept.dtypes if c != "vector")
        sent = spark.sparkContext.broadcast(books.parts)
        coded = kept.where(fits).mapInArrow(_codes(sent, ["vec_id", "label"]), f"{kinds}, {CODE_SCHEMA}")
        coded = stored(coded.unionByName(_uncoded(kept.where(~fits))), "vector_codes")
    return with_group_stats(coded, ["label"], {"label_error": F.sum("error")}), books
