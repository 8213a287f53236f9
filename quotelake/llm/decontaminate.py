"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item inside a long document has almost no Jaccard similarity with it. So items are
partitioned by size, and for each partition the documents are cut into windows of matching size, half
overlapping, such that an item lies in one window whole: of an item of u/2 to u shingles and a window
of 2u, at containment 0.8 the similarity is 0.19 or more, and one of 64 MinHash values agrees but
for once in 700,000 times. Agreeing pairs are verified by exact containment in the whole document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.grams import RUN_CHARS, U64, plain_runs, salt, shingles, word_hashes
from quotelake.llm.shared import stored, text_runs

HASHES, WIDTH = 64, 5
#: A block of the benchmark holds about so many items and characters; each block is one pass.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 1 << 26
LEAKS = "array<struct<item_id:bigint,n_shared:int,n_item:int>>"


def _hashed(grams: np.ndarray, k: int) -> np.ndarray:
    return (grams ^ salt(2 * k + 900)) * (salt(2 * k + 901) | U64(1))


@dataclass(frozen=True)
class Partition:
    """The items of one size class: their MinHash keys, sorted, and a bitmap of the keys' first bits."""

    size: int
    keys: np.ndarray
    items: np.ndarray
    bitmap: np.ndarray
    shift: int


@dataclass(frozen=True)
class Items:
    """A block of the benchmark, made for searching."""

    ids: tuple[int | None, ...]
    grams: tuple[np.ndarray, ...]  # the distinct shingles of each item, sorted
    partitions: tuple[Partition, ...]
    short: tuple[tuple[int, np.ndarray, np.ndarray], ...]  # by words: hashes of the items that short, sorted, and the items

    @classmethod
    def of(cls, ids: list[int | None], texts: list[str | None]) -> Items:
        words, word_starts = word_hashes(texts)
        hashes, starts = shingles(words, word_starts, WIDTH)
        grams = tuple(np.unique(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True))
        by_size: dict[int, list[int]] = {}
        by_words: dict[int, list[int]] = {}
        for i, (own, count) in enumerate(zip(grams, np.diff(word_starts).tolist(), strict=True)):
            if 0 < count < WIDTH:
                by_words.setdefault(count, []).append(i)
            elif len(own):
                by_size.setdefault(1 << (len(own) - 1).bit_length(), []).append(i)
        partitions = []
        for size, own in sorted(by_size.items()):
            keys = np.array([[_hashed(grams[i], k).min() ^ salt(k) for k in range(HASHES)] for i in own], U64)
            items = np.repeat(np.array(own), HASHES)
            order = np.argsort(keys.ravel(), kind="stable")
            width = max(20, (16 * keys.size - 1).bit_length())
            bitmap = np.zeros(1 << width, bool)
            bitmap[keys.ravel() >> U64(64 - width)] = True
            partitions.append(Partition(size, keys.ravel()[order], items[order], bitmap, 64 - width))
        short = []
        for count, own in sorted(by_words.items()):
            keys = np.array([grams[i][0] for i in own], U64)
            order = np.argsort(keys, kind="stable")
            short.append((count, keys[order], np.array(own)[order]))
        return cls(tuple(ids), grams, tuple(partitions), tuple(short))

    def short_hits(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Pairs of document and item of fewer than WIDTH words that it holds, each once."""
        found = [np.zeros((0, 2), np.int64)]
        for count, keys, items in self.short:
            runs, at = plain_runs(words, starts, count, WIDTH)
            low, high = np.searchsorted(keys, runs, "left"), np.searchsorted(keys, runs, "right")
            hit = np.flatnonzero(high > low)
            for shift in range(int((high - low).max(initial=0))):  # items that repeat
                more = hit[low[hit] + shift < high[hit]]
                found.append(np.stack([at[more], items[low[more] + shift]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def candidates(self, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Pairs of document and item that agree in a MinHash value of some window, each once."""
        found = [np.zeros((0, 2), np.int64)]
        filled = np.flatnonzero(np.diff(starts))
        if not len(filled) or not self.partitions:
            return found[0]
        counts = np.diff(starts)[filled]
        size = self.partitions[0].size
        blocks = -(-counts // size)
        ends = np.cumsum(blocks)
        at = np.repeat(starts[:-1][filled], blocks) + size * (np.arange(ends[-1]) - np.repeat(ends - blocks, blocks))
        least = np.stack([np.minimum.reduceat(_hashed(grams, k), at) ^ salt(k) for k in range(HASHES)], 1)
        plain = np.array([salt(k) for k in range(HASHES)])
        for part in self.partitions:
            while size < part.size:  # two neighbouring blocks of one document become one
                number = np.arange(ends[-1]) - np.repeat(ends - blocks, blocks)
                least = np.minimum.reduceat(least ^ plain, np.flatnonzero(number % 2 == 0), axis=0) ^ plain
                size, blocks = 2 * size, -(-blocks // 2)
                ends = np.cumsum(blocks)
            windows = least ^ plain
            last = np.zeros(len(windows), bool)
            last[ends - 1] = True
            windows[:-1] = np.where(last[:-1, None], windows[:-1], np.minimum(windows[:-1], windows[1:]))
            windows ^= plain
            hit, column = np.nonzero(part.bitmap[windows >> U64(part.shift)])
            keys = windows[hit, column]
            low, high = np.searchsorted(part.keys, keys, "left"), np.searchsorted(part.keys, keys, "right")
            held = high - low
            total = np.cumsum(held)
            if len(total) and total[-1]:
                place = np.repeat(low - total + held, held) + np.arange(total[-1])
                document = np.repeat(filled[np.searchsorted(ends, hit, "right")], held)
                found.append(np.unique(np.stack([document, part.items[place]], 1), axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, texts: list[str | None], threshold: float) -> list[list[dict[str, int | None]]]:
        """For each text the items whose shingles it holds to a share of at least `threshold`."""
        words, word_starts = word_hashes(texts)
        grams, starts = shingles(words, word_starts, WIDTH)
        out: list[list[dict[str, int | None]]] = [[] for _ in texts]
        for row, item in self.short_hits(words, word_starts).tolist():
            out[row].append({"item_id": self.ids[item], "n_shared": 1, "n_item": 1})
        document, own = -1, grams
        for row, item in self.candidates(grams, starts).tolist():
            if row != document:
                document, own = row, np.unique(grams[starts[row] : starts[row + 1]])
            wanted = self.grams[item]
            place = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            shared = int((own[place] == wanted).sum())
            if shared >= threshold * len(wanted):
                out[row].append({"item_id": self.ids[item], "n_shared": shared, "n_item": len(wanted)})
        return out


def _search(spark, items: Items, threshold: float):
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(LEAKS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, out = batch.tolist(), []
            for own in text_runs(texts, RUN_CHARS):
                out += shared.value.leaks(texts[own], threshold)
            yield pd.Series(out, dtype=object)

    return search


def _blocks(spark: SparkSession, benchmark: DataFrame, threshold: float) -> Iterator[tuple[Callable[[Column], Column], bool]]:
    """A function from a text to its leaks for each block of the benchmark, and whether it is the last one."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    sizes = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    count = max(1, math.ceil(sizes.n / BLOCK_ITEMS), math.ceil(sizes.chars / BLOCK_CHARS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        rows = items.where(block == i).collect()  # one block, bounded as said
        yield _search(spark, Items.of(*(zip(*rows, strict=True) if rows else ((), ()))), threshold), i == count - 1


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """`doc_id, item_id, n_shared, n_item, containment`: one row for each document (`doc_id, text`) and each
    item of `benchmark` (`item_id, text`) that it holds.

    An item is held if at least `threshold` of its distinct five-word shingles occur in the document, and
    they do so near to each other (within twice its length, which is how the search finds it). Words
    are runs of letters and digits in any case. An item of one to four words is one shingle, which is
    held by a document in which those words stand in a row; one without words, or a null, is held by
    none. Items that repeat are found each. The benchmark is taken in blocks of bounded size, each of
    which is sent to all tasks and costs one pass over the texts; the result of each pass is written
    before the next block is sent.
    """
    found = []
    for search, last in _blocks(docs.sparkSession, benchmark, threshold):
        held = docs.select("doc_id", F.explode(search(docs["text"])).alias("leak")).select("doc_id", "leak.*")
        found.append(held if last and not found else stored(held, "leaks"))
    return reduce(DataFrame.unionByName, found).withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of `docs`, with all columns, that hold no item."""
    for search, last in _blocks(docs.sparkSession, benchmark, threshold):
        docs = docs.where(F.size(search(docs["text"])) == 0)
        docs = docs if last else stored(docs, "clean")
    return docs
