"""What the operators share: written intermediates, text batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import fresh_path

#: Rows of an Arrow batch. Texts are long: Spark's 10,000 of them fill some 40 MB in the JVM, in its copy for the
#: worker and in the worker, for every task. A session that asks for another number keeps it.
BATCH_ROWS, SPARK_BATCH_ROWS = 1_000, "10000"

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Python workers that start from now on find this package where the driver found it, and get
    texts in batches of BATCH_ROWS.

    On a cluster the package is installed or passed with --py-files; this serves drivers
    that import it from a folder that is not their working directory.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == SPARK_BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    environment = spark.sparkContext.environment
    paths = [p for p in (environment.get("PYTHONPATH"), os.environ.get("PYTHONPATH")) if p]
    if PACKAGE_ROOT not in os.pathsep.join(paths).split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


#: Spark's switch for deleting the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, and safe from lost executors. What
    it was shuffled through is not needed any more and goes at once."""
    return written(df, name)[0]


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same, and its path, for `remove_path` when nothing reads it any more."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """The same for small tables. Rows in a checkpoint are neither compressed nor read by column, but a task
    writes them many times faster than a Parquet file, which counts where tasks are many and rounds
    follow each other. Without a checkpoint folder it is `stored`."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        return stored(df, name)
    return df.checkpoint()


def row_key() -> tuple[Column, Column]:
    """Two hashes of `doc_id` and `text` that stand for a row: rows that repeat both have the same."""
    doc_id, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    return F.xxhash64(doc_id.isNull(), doc_id, text), F.hash(text)


def keyed(docs: DataFrame) -> DataFrame:
    """`doc_id, row, tie, text`, the key of a row being `row` and `tie`; other columns go."""
    row, tie = row_key()
    doc_id, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), row.alias("row"), tie.alias("tie"), text.alias("text"))


def free_names(df: DataFrame, *bases: str) -> list[str]:
    """The names `bases`, lengthened until `df` has no column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in bases:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_found(docs: DataFrame, found: DataFrame, how: str = "left") -> tuple[DataFrame, dict[str, str]]:
    """`docs`, all columns, joined with `found` (`row, tie` as `row_key` gives them, and others), and the
    names that the columns of `found` have in the result."""
    names = dict(zip(found.columns, free_names(docs, *found.columns), strict=True))
    row, tie = row_key()
    marked = docs.withColumns({names["row"]: row, names["tie"]: tie})
    return marked.join(found.withColumnsRenamed(names), [names["row"], names["tie"]], how), names


def tidy(function: Callable) -> Callable:
    """`function` over batches, after which the worker gives the memory that it no longer uses back:
    workers are reused, and what one holds is missing to the next stage on that executor."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()

    return run


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def text_runs(texts: Sequence[str | None], most: int) -> Iterator[slice]:
    """Slices of consecutive texts with at most `most` characters each, or one longer text alone."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > begin and size + n > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts))


def finite(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))
