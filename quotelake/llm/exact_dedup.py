"""Documents with equal texts, found by progressive refinement.

Equal texts have equal lengths, then equal prefixes, then equal hashes of the whole text. The
first two are taken from one narrow pass; whole texts are only hashed in groups that survive
both. A level hands its survivors to the next pass as a sieve, a bitmap of fixed size that is
broadcast, so no text is moved to be compared. A sieve lets every survivor through; what it lets
through by mistake costs one hash and turns out to be alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.shared import stored
from quotelake.operators.windows import with_group_stats

#: Code points of the prefix that is compared before whole texts are.
PREFIX = 256
#: Bits of a sieve. It is broadcast as words of 64 bits, empty ones left out: 2^20 rows of two longs at most.
SIEVE_BITS = 1 << 26


def _place(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(SIEVE_BITS))


def _sieve(rows: DataFrame, *keys: str) -> DataFrame:
    """`word, bits`: a bit is set for every value of `keys` that more than one row has."""
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    at = repeated.select(_place(*[F.col(k) for k in keys]).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    return at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _sift(rows: DataFrame, sieve: DataFrame, name: str, *keys: str) -> DataFrame:
    """`rows` with the boolean `name`: whether another row may have the same `keys`."""
    at = _place(*[F.col(k) for k in keys])
    placed = rows.withColumn("_at", at).withColumn("word", F.shiftright("_at", 6))
    found = placed.join(F.broadcast(sieve), "word", "left")
    bit = F.call_function("getbit", F.coalesce("bits", F.lit(0).cast("bigint")), F.col("_at").bitwiseAND(63).cast("int"))
    return found.withColumn(name, bit == 1).drop("word", "bits", "_at")


def _heads(rows: DataFrame, text: str) -> DataFrame:
    """`rows` with the length in bytes and a hash of the prefix of the column `text`."""
    return rows.withColumn("n_bytes", F.octet_length(text)).withColumn("head", F.xxhash64(F.left(text, F.lit(PREFIX))))


def _content(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """`columns` of `docs` with `n_bytes` and `full`, the hash of the whole text, or NULL where
    length and prefix show that no other text is equal."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    heads = stored(_heads(docs.select(body.alias("body")), "body").select("n_bytes", "head"), "text_heads")
    lengths = _sieve(heads, "n_bytes")
    again = _sift(heads, lengths, "same_length", "n_bytes").where("same_length")
    prefixes = stored(_sieve(again, "n_bytes", "head"), "text_prefixes")
    rows = _heads(docs.select(*columns, body.alias("body")), "body")
    survivors = _sift(rows, prefixes, "survives", "n_bytes", "head")
    full = F.when(F.col("survives"), F.unhex(F.sha2("body", 256)))
    return survivors.withColumn("full", full).drop("body", "head", "survives")


def exact_groups(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """`doc_id, keep_id, group_size, kept` for every row of `docs` (`doc_id, text`).

    Rows whose texts are identical, byte by byte, form a group; a null text counts as empty. Of a
    group the row with the largest `doc_id` stays, a null one being smaller than all others; of
    rows that repeat that id, too, exactly one stays. `keep_id` is its id and `group_size` the
    number of rows. `carry` names further columns, computed from those of `docs` in the pass that
    hashes texts. Other columns are not read.
    """
    carry = carry or {}
    taken = {"doc_id", "keep_id", "group_size", "kept", "row", "full", "body", "head", "n_bytes", "survives", "word", "bits", "_at"}
    if clash := taken & carry.keys():
        raise ValueError(f"columns to carry have names of the result or of its making: {sorted(clash)}")
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), *[c.alias(name) for name, c in carry.items()]]
    rows = stored(_content(docs, columns).withColumn("row", F.monotonically_increasing_id()), "text_hashes")
    alone = rows.where("full is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), *carry
    )
    stats = {
        "keep_id": F.max("doc_id"),
        "keep_row": F.coalesce(F.max_by("row", "doc_id"), F.max("row")),
        "group_size": F.count(F.lit(1)),
    }
    grouped = with_group_stats(rows.where("full is not null"), ["n_bytes", "full"], stats)
    kept = (F.col("row") == F.col("keep_row")).alias("kept")
    return alone.unionByName(grouped.select("doc_id", "keep_id", "group_size", kept, *carry))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay (see `exact_groups`), all columns.

    Rows that repeat both text and id are told apart by a hash of the other columns that Spark
    can hash; of rows equal in all of them any one stays. Each task first cuts its own copies
    down to one, and rows without a possible copy are not moved at all.
    """
    hashed = [F.col(f"`{n}`") for n, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.struct(F.col("doc_id").cast("bigint"), F.xxhash64(*hashed), F.hash(*hashed))
    whole = F.struct(*[F.col(f"`{n}`") for n in docs.columns])
    rows = _content(docs, [whole.alias("whole"), order.alias("place")])
    copies = rows.where("full is not null").groupBy("n_bytes", "full").agg(F.max_by("whole", "place").alias("whole"))
    return rows.where("full is null").select("whole").unionByName(copies.select("whole")).select("whole.*")
