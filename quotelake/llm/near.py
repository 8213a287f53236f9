"""Groups of near-duplicate units: buckets, verified links, connected components.

A unit is a content (a document's or paragraph's words), named by 16 bytes, so exact copies are one
unit from the start. Units that share a bucket are candidates. No bucket is expanded into all its
pairs: first each member is compared with one hub; members that this leaves in different
components are then compared with each other where they share one of their rarest shingles and
have enough of the others left for a link.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.grams import U64, mix, salt
from quotelake.llm.shared import checkpointed, stored
from quotelake.operators.windows import with_group_stats

GRAM_BYTES = 5  # of a shingle's hash that a stored set keeps
#: What a bound on a count of grams may be off in floating point.
ROUNDING = 1e-6


def unit_names(first: np.ndarray, second: np.ndarray) -> pa.Array:
    """16-byte names from two hashes each."""
    raw = np.stack([first, second], 1).astype("<u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(first), [None, pa.py_buffer(raw)]).cast(pa.binary())


def sequence_names(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes for the sequence of words in each segment; zeros for an empty one."""
    counts = np.diff(starts)
    place = np.arange(len(words)) - np.repeat(starts[:-1], counts)
    out = []
    for k in (11, 12):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(words + mix(place.astype(U64) + salt(k))))])
        out.append(np.where(counts > 0, mix(sums[starts[1:]] - sums[starts[:-1]] + counts.astype(U64)), U64(0)))
    return out[0], out[1]


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One key for each band of `rows` signature values: an array of units by bands."""
    count = signatures.shape[1] // rows
    out = np.empty((len(signatures), count), U64)
    for band in range(count):
        key = np.full(len(signatures), salt(100 + band), U64)
        for r in range(rows):
            key = mix(key + signatures[:, band * rows + r])
        out[:, band] = key
    return out


def lists(values: np.ndarray) -> pa.Array:
    """A column of lists, one for each row of a matrix."""
    n, width = values.shape
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), flat)


def gram_sets(grams: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Each segment's hashes, sorted, with GRAM_BYTES bytes of each."""
    raw = np.ascontiguousarray((grams >> U64(64 - 8 * GRAM_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES])
    raw = raw.tobytes()
    return [raw[GRAM_BYTES * a : GRAM_BYTES * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def shared_buckets(keys: DataFrame) -> DataFrame:
    """`bucket, unit, hub` of buckets with several units; `keys` has `unit, bands`.

    Which buckets hold several units is found by aggregation over short hashes, so a bucket that
    all copies of a text share is one row of a task, and only members of the others go further.
    The hub is the member that meets the most units in all its buckets: of a family of variants
    the one nearest to all others, so that most links of the family are links to its hubs.
    """
    members = keys.where("unit is not null").select(F.explode("bands").alias("bucket"), "unit")
    short = F.xxhash64("unit")
    several = members.groupBy("bucket").agg(F.min(short).alias("low"), F.max(short).alias("high")).where("low < high")
    found = stored(members.join(several.select("bucket"), "bucket", "left_semi").distinct(), "members")
    sized = with_group_stats(found, ["bucket"], {"size": F.count("*")})
    # A unit has a few buckets only; a bucket may have many units, so its key is one that a join can split.
    met = found.join(sized.groupBy("unit").agg(F.sum("size").alias("met")), "unit")
    hubs = met.groupBy(F.struct("bucket").alias("key")).agg(F.max(F.struct("met", "unit"))["unit"].alias("hub"))
    return stored(found.join(hubs.select("key.bucket", "hub"), "bucket").select("bucket", "unit", "hub"), "buckets")


def _similar(threshold: float):
    def run(batches):
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                x, y = (np.frombuffer(s, f"V{GRAM_BYTES}") for s in (x, y))
                both = len(x) + len(y)
                shared = both - _distinct(x, y)
                if shared >= threshold * (both - shared):
                    keep.append(i)
            yield batch.drop_columns(["left", "right"]).take(pa.array(keep, pa.int64()))

    return run


def _distinct(x: np.ndarray, y: np.ndarray) -> int:
    """How many different hashes two sets hold together."""
    wide = np.zeros((len(x) + len(y), 8), np.uint8)
    wide[:, :GRAM_BYTES] = np.concatenate([x, y]).view(np.uint8).reshape(-1, GRAM_BYTES)
    values = np.sort(wide.view("<u8").ravel())
    return int((values[1:] != values[:-1]).sum()) + (len(values) > 0)


def _possible(a: str, b: str, threshold: float, bits: int, most_bits: int) -> Column:
    """Whether sizes and sketches of two units allow the similarity."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    fits = (na >= threshold * nb) & (nb >= threshold * na)
    if bits:
        pairs = [(F.get(f"{a}.bits", F.lit(i)), F.get(f"{b}.bits", F.lit(i))) for i in range(bits // 64)]
        fits &= reduce(Column.__add__, [F.bit_count(x.bitwiseXOR(y)) for x, y in pairs]) <= most_bits
    return fits


def verified_links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of `pairs` (`a, b` and others) whose sets have a Jaccard similarity of at least `threshold`."""
    grams = sets.select("unit", "grams")
    met = pairs.join(grams.withColumnsRenamed({"unit": "a", "grams": "left"}), "a")
    met = met.join(grams.withColumnsRenamed({"unit": "b", "grams": "right"}), "b").select(*pairs.columns, "left", "right")
    return met.mapInArrow(_similar(threshold), pairs.schema)


def _owned_grams(batches):
    """One row for each gram of each set."""
    for batch in batches:
        sets = batch.column(2).to_pylist()
        sizes = [len(x) // GRAM_BYTES for x in sets]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, :GRAM_BYTES] = np.frombuffer(b"".join(sets), np.uint8).reshape(-1, GRAM_BYTES)
        owners, counts = (np.repeat(batch.column(i).to_numpy(zero_copy_only=False), sizes) for i in (0, 1))
        yield pa.record_batch([pa.array(wide.view("<i8").ravel()), pa.array(owners), pa.array(counts)], ["gram", "owner", "n"])


def rare_grams(sets: DataFrame, threshold: float) -> DataFrame:
    """`gram, owner, n, rest`: of each set the grams by which it can meet a similar one.

    All sets have their grams in one order, the rarest first; `rest` counts those from this gram to the
    last. Of two sets, all that they share lies in the rest of both from the first gram that they share, so a
    pair is needed only at a gram after which enough is left. Variants of one text that each differ from
    it in their own places have few such grams, or none, in common.
    """
    owned = sets.select(F.xxhash64("unit").alias("owner"), "n", "grams")
    owned = owned.mapInArrow(_owned_grams, "gram bigint, owner bigint, n int")
    times = owned.groupBy(F.struct("gram").alias("key")).agg(F.count("*").alias("times")).where("times > 1")
    met = owned.join(times.select("key.gram", "times"), "gram")
    last = Window.partitionBy("owner").orderBy(F.desc("times"), F.desc("gram"))
    met = met.withColumn("rest", F.row_number().over(last)).drop("times")
    return met.where(F.col("rest") >= threshold * F.col("n") - ROUNDING)


def group_units(buckets: DataFrame, sets: DataFrame, threshold: float, bits: int = 0, most_bits: int = 0) -> DataFrame:
    """`unit, root` for every unit that has a link; linked units have one root, the smallest of them.

    `buckets` is from `shared_buckets`; `sets` has `unit, n, bits, grams` for each unit in it: the size
    of its set, an optional sketch of `bits` bits of which at most `most_bits` may differ between
    similar units, and the set.
    """

    def with_light(df: DataFrame, column: str, light: DataFrame) -> DataFrame:
        values = F.struct(*[c for c in light.columns if c != "unit"]).alias(f"{column}_")
        return df.join(light.select(F.col("unit").alias(column), values), column)

    possible = _possible("a_", "b_", threshold, bits, most_bits)
    light = sets.select("unit", "n", "bits")
    pairs = buckets.where("unit <> hub").select(F.least("hub", "unit").alias("a"), F.greatest("hub", "unit").alias("b")).distinct()
    pairs = with_light(with_light(pairs, "a", light), "b", light).where(possible).select("a", "b")
    roots = components(verified_links(pairs, sets, threshold))
    # What one hub did not join: members of other components that may still be similar.
    placed = buckets.join(roots, "unit", "left").withColumn("root", F.coalesce("root", "unit"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_ = stored(placed.where("unit <> hub").join(mixed.select("bucket"), "bucket", "left_semi").drop("hub"), "open_buckets")
    own = open_.groupBy("unit").agg(F.collect_set("bucket").alias("buckets"), F.min("root").alias("root"))
    own = stored(own.withColumn("owner", F.xxhash64("unit")), "open_units")
    rare = rare_grams(sets.join(own.select("unit"), "unit", "left_semi"), threshold)
    second = verified_links(crossing_pairs(rare.join(own.select("owner", "root"), "owner"), own, threshold), sets, threshold)
    # Only the roots that these links join need a new one.
    joined = components(second.select(F.col("root").alias("a"), F.col("root_b").alias("b")))
    moved = roots.join(joined.select(F.col("unit").alias("root"), F.col("root").alias("top")), "root", "left")
    return moved.select("unit", F.coalesce("top", "root").alias("root")).unionByName(joined)


def crossing_pairs(rare: DataFrame, own: DataFrame, threshold: float) -> DataFrame:
    """`a, b, root, root_b`: pairs of units of different roots that share a bucket and may be similar.

    `rare` is from `rare_grams`, with the roots; `own` has `unit, owner, root, buckets`.
    """
    # Rows of the root that has a gram most often meet those of the others, and not each other.
    roots = rare.groupBy(F.struct("gram", "root").alias("key")).agg(F.count("*").alias("times")).select("key.*", "times")
    most = roots.groupBy(F.struct("gram").alias("key")).agg(F.max(F.struct("times", "root"))["root"].alias("main"), F.count("*").alias("roots"))
    rare = stored(rare.join(most.where("roots > 1").select("key.gram", "main"), "gram"), "rare_grams")
    others = rare.withColumnsRenamed({"owner": "owner_b", "n": "n_b", "rest": "rest_b", "root": "root_b"}).drop("main")
    common = F.least("rest", "rest_b")
    enough = common >= threshold * (F.col("n") + F.col("n_b") - common) - ROUNDING
    apart = (F.col("root") != F.col("root_b")) & ((F.col("owner") < F.col("owner_b")) | (F.col("root_b") == F.col("main")))
    met = rare.where("root <> main").join(others, "gram").where(apart & enough)
    met = met.select(F.least("owner", "owner_b").alias("owner"), F.greatest("owner", "owner_b").alias("owner_b")).distinct()
    first = own.select("owner", F.col("unit").alias("a"), "root", "buckets")
    second = own.select(F.col("owner").alias("owner_b"), F.col("unit").alias("b"), F.col("root").alias("root_b"), F.col("buckets").alias("more"))
    met = met.join(first, "owner").join(second, "owner_b").where(F.arrays_overlap("buckets", "more"))
    return met.select("a", "b", "root", "root_b")


def components(links: DataFrame) -> DataFrame:
    """`unit, root` for each unit of `links` (`a, b`); the root is the smallest unit it is linked to.

    Alternates two steps until each component is a star around its root: every unit hands its larger
    neighbours to the smallest one, then its smaller ones. Each round is a few keyed jobs, and its
    edges are checkpointed.
    """
    edges = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("low").alias("b")).repartition("a")
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.col("b").alias("u"), "low", "a")
        small = small.select(F.explode(F.array("u", "a")).alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        edges = checkpointed(small, "edges")
    return edges.select(F.col("a").alias("unit"), F.col("b").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether each `a` has one edge and no `b` is an `a`; each `a` is larger than its `b`."""
    ends = [F.struct(F.col(c).alias("unit"), F.lit(n).alias("n")) for c, n in (("a", 1), ("b", 0))]
    units = edges.select(F.inline(F.array(*ends))).groupBy("unit").agg(F.sum("n").alias("lower"), F.min("n").alias("least"))
    return units.where("lower > 1 or lower = 1 and least = 0").count() == 0
