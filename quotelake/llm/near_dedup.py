"""Near-duplicate documents by DartMinHash.

A document is a weighted set: its five-word shingles with their counts. Darts fall on the plane of
weight and rank at places that only the shingle decides, and a document catches those that land
below its weights; of each coordinate of the signature the dart of lowest rank counts. Only about as
many darts are drawn as the signature needs, however long the document, and two documents agree
in a coordinate with the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.grams import RUN_CHARS, U64, mix, numbered_repeats, salt, shingles, word_hashes
from quotelake.llm.near import band_keys, gram_sets, group_units, lists, sequence_names, shared_buckets, unit_names
from quotelake.llm.shared import checkpointed, free_names, keyed, stored, text_runs, with_found
from quotelake.operators.windows import with_group_stats

ROWS, BANDS = 4, 25  # a pair of similarity 0.8 misses all bands once in 500,000 times
COORDINATES = ROWS * BANDS
DARTS = COORDINATES * (math.log(COORDINATES) + 3)  # expected for each document; a signature then has a gap once in 20 times
#: The sketch: of each cell's lowest dart one bit. At similarity 0.8 about 51 of 512 bits differ; 100 is seven deviations more.
SKETCH_BITS, MOST_BITS = 512, 100
SKETCH_SCHEMA = "doc_id bigint, row bigint, tie int, unit binary, bands array<bigint>"
SET_SCHEMA = "unit binary, n int, bits array<bigint>, grams binary"


def throw_darts(elements: np.ndarray, owner: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All darts in the regions of unit weight of `elements`, up to the rank `limit` of their owner.

    Along the rank axis the darts of a region are a Poisson process of rate 1 that its hash decides.
    Returns owner, rank and id of each dart.
    """
    out = []
    at, rank, step = np.arange(len(elements)), np.zeros(len(elements)), 0
    while len(at):
        # Few regions left are advanced by many darts at once.
        count = max(1, min(64, 100_000 // len(at)))
        salts = np.array([[salt(2 * k), salt(2 * k + 1)] for k in range(step, step + count)])
        drawn = mix(elements[at][:, None] + salts[:, 0])
        gaps = -np.log1p(-(drawn >> U64(11)).astype(float) * 2.0**-53)
        ranks = rank[at][:, None] + np.cumsum(gaps, axis=1)
        below = ranks < limit[owner[at]][:, None]
        ids = mix(elements[at][:, None] + salts[:, 1])
        out.append((np.repeat(owner[at], count)[below.ravel()], ranks[below], ids[below]))
        rank[at] = ranks[:, -1]
        at, step = at[below[:, -1]], step + count
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(3))


def _lowest(owner: np.ndarray, rank: np.ndarray, ids: np.ndarray, cell: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """The id of the dart of lowest rank for each owner and cell; 0 where there is none."""
    flat = owner.astype(np.int64) * size[1] + cell.astype(np.int64)
    best = np.full(size[0] * size[1], np.inf)
    np.minimum.at(best, flat, rank)
    hit = rank == best[flat]
    found = np.zeros(len(best), U64)
    found[flat[hit]] = ids[hit] | U64(1)
    return found.reshape(size)


def dart_signatures(elements: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signature and sketch of each set of unit-weight `elements`; zeros for an empty set."""
    n, weight = len(starts) - 1, np.diff(starts)
    owner = np.repeat(np.arange(n), weight)
    limit = DARTS / np.maximum(weight, 1)
    who, rank, ids = throw_darts(elements, owner, limit)
    bits = _lowest(who, rank, ids, (ids >> U64(40)) % U64(SKETCH_BITS), (n, SKETCH_BITS))
    bits = np.packbits(((bits >> U64(20)) & U64(1)).astype(np.uint8), axis=1).view("<u8")
    signatures = _lowest(who, rank, ids, ids % U64(COORDINATES), (n, COORDINATES))
    while len(open_ := np.flatnonzero(((signatures == 0).any(1)) & (weight > 0))):
        # A coordinate without a dart: look further up, for this document alone.
        place = np.full(n, -1)
        place[open_] = np.arange(len(open_))
        mine = place[owner] >= 0
        limit = limit * 2
        who, rank, ids = throw_darts(elements[mine], place[owner[mine]], limit[open_])
        signatures[open_] = _lowest(who, rank, ids, ids % U64(COORDINATES), (len(open_), COORDINATES))
    return signatures, bits


def _runs(texts: list[str | None]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, pa.Array]]:
    """For runs of texts: their unit-weight elements, where each text's begin, and the names of the units."""
    for own in text_runs(texts, RUN_CHARS):
        words, word_starts = word_hashes(texts[own])
        grams, starts = shingles(words, word_starts)
        names = list(sequence_names(words, word_starts))
        for i in np.flatnonzero(np.diff(word_starts) == 0):
            # A text without words is as its bytes are.
            digest = hashlib.md5((texts[own][i] or "").encode(), usedforsecurity=False).digest()
            names[0][i], names[1][i] = np.frombuffer(digest, "<u8")
        yield own, numbered_repeats(grams, starts), starts, unit_names(*names)


def _sketch(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for own, elements, starts, units in _runs(texts):
            keys = band_keys(dart_signatures(elements, starts)[0], ROWS)
            # A text without words has no bands.
            filled = np.diff(starts) > 0
            bands = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(filled, BANDS, 0))]), pa.int32()), lists(keys[filled]).values
            )
            rows = [batch.column(c).slice(own.start, own.stop - own.start) for c in ("doc_id", "row", "tie")]
            yield pa.record_batch([*rows, units, bands], ["doc_id", "row", "tie", "unit", "bands"])


def _sets(batches):
    for batch in batches:
        for _, elements, starts, units in _runs(batch.column("text").to_pylist()):
            bits = dart_signatures(elements, starts)[1]
            yield pa.record_batch(
                [units, pa.array(np.diff(starts).astype(np.int32)), lists(bits), pa.array(gram_sets(elements, starts), pa.binary())],
                ["unit", "n", "bits", "grams"],
            )


def _grouped(docs: DataFrame, threshold: float) -> DataFrame:
    """`doc_id, row, tie, root` of every document with a text; near copies have one root."""
    source = keyed(docs).where("text is not null")
    sketch = stored(source.mapInArrow(_sketch, SKETCH_SCHEMA), "sketch")
    buckets = shared_buckets(sketch)
    # One document for each candidate unit gives its set.
    picked = sketch.join(buckets.select("unit").distinct(), "unit", "left_semi").groupBy("unit")
    picked = picked.agg(F.min(F.struct("row", "tie")).alias("one")).select("one.row", "one.tie")
    sets = stored(source.join(picked, ["row", "tie"], "left_semi").mapInArrow(_sets, SET_SCHEMA).dropDuplicates(["unit"]), "sets")
    roots = group_units(buckets, sets, threshold, SKETCH_BITS, MOST_BITS)
    named = sketch.select("doc_id", "row", "tie", "unit").join(roots, "unit", "left")
    return named.select("doc_id", "row", "tie", F.coalesce("root", "unit").alias("root"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """`doc_id, class_id, class_size` for every row of `docs` (`doc_id, text`).

    Two documents are linked if their five-word shingles, with counts, have a weighted Jaccard
    similarity of at least `threshold` (0.8 or more) and their signatures agree in a band; a class is a connected
    component, named by its smallest id. Words are runs of letters and digits in any case; a text
    of one to four words is one shingle, and one without words is only like its exact copies. A
    null text is a class of its own, named by its id; so is a class of null ids, with a null name.
    Repeated rows are copies. Other columns are not read.
    """
    if threshold < 0.8:
        raise ValueError("the bands are made for similarities of 0.8 or more")
    grouped = checkpointed(_grouped(docs, threshold).select("doc_id", "root"), "near_groups")
    # A class may hold a third of all documents; the join is one in which such a key can be split.
    stats = {"class_id": F.min("doc_id"), "class_size": F.count("*")}
    found = with_group_stats(grouped, ["root"], stats).select("doc_id", "class_id", "class_size")
    lone = docs.where("text is null").select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return found.unionByName(lone.withColumns({"class_id": F.col("doc_id"), "class_size": F.lit(1).cast("bigint")}))


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of each class of `near_duplicates`, with all columns: that of the smallest id, of those
    that share it the one whose text has the smallest hash, and of repeated rows any one. A null id comes
    last, and rows with a null text all stay."""
    grouped = _grouped(docs, threshold)
    first = Window.partitionBy("root").orderBy(F.asc_nulls_last("doc_id"), "row", "tie")
    kept = grouped.withColumn("place", F.row_number().over(first)).where("place = 1").select("row", "tie")
    chosen, names = with_found(docs.where("text is not null"), kept, "left_semi")
    key, [copy] = [names["row"], names["tie"]], free_names(chosen, "copy")
    once = chosen.withColumn(copy, F.row_number().over(Window.partitionBy(*key).orderBy(key[0]))).where(F.col(copy) == 1)
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where("text is null"))
