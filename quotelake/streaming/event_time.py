"""Counts and bursts of posts kept up to date by streams that look at event time.

Both rest on Spark's watermark: the latest time seen in earlier batches, less the allowed delay. What
is open is held in Spark's state store and closed by the watermark; what a batch changes is merged
into stored tables by its key, so a batch that is repeated after a failure changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake import schemas as S
from quotelake.operators.merge import merge_latest
from quotelake.operators.windows import keep_latest
from quotelake.sources.snapshots import LakeTable

BY_DAY = {"day": lambda: F.date_format("hour", "yyyy-MM-dd")}


def hour_counts(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """`keys, hour, n` of rows that are in time. Of a stream, rows whose hour the watermark has passed are
    left out; of a table all rows are in time."""
    counted = _marked(rows, time, delay).groupBy(F.window("_time", "1 hour").alias("_hour"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("_hour.start").cast("timestamp_ntz").alias("hour"), "n")


def bursts(rows: DataFrame, keys: list[str], time: str, gap_seconds: int, delay: str) -> DataFrame:
    """`keys, session_start, session_end, n` as `operators.temporal.sessions` gives them; of a stream, each
    burst once the watermark has passed its end and the gap."""
    window = F.session_window("_time", f"{gap_seconds} seconds").alias("_window")
    found = _marked(rows, time, delay).groupBy(window, *keys).agg(
        F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n")
    )
    return found.select(*keys, "session_start", "session_end", "n")


def _marked(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermarks need times with a zone; that of the session is put on and taken off again."""
    return rows.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)


class HourlyPosts:
    """Posts per hour in a folder of its own: `counts` of those in time, `arrivals` of all.

    `arrivals` has a row for each batch and hour, which is what makes late rows countable: the state store
    drops them, so they are what arrived and is not in `counts`. Each table is partitioned by day, and
    a batch rewrites the days that its rows fall into.
    """

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], time: str, delay: str):
        """`keys` maps key columns to their types."""
        self.spark, self.path, self.time, self.delay = spark, path, time, delay
        self.keys = list(keys)
        names = ", ".join(f"`{k}` {t}" for k, t in keys.items())
        schema = lambda more: S.schema(f"{names}, hour timestamp_ntz, n bigint{more}")
        self.counts = LakeTable(f"{path}/counts", schema(""), BY_DAY, ("hour",))
        self.arrivals = LakeTable(f"{path}/arrivals", schema(", batch bigint"), BY_DAY, ("hour",))

    def advance(self, read: Callable[[], DataFrame]) -> None:
        """Take in what has come to the source since the last call. `read` opens it as a stream."""
        in_time = hour_counts(read(), self.keys, self.time, self.delay)
        self._run(in_time, "counts", "update", self._store(self.counts, [*self.keys, "hour"]))
        self._run(read().select(*self.keys, self.time), "arrivals", "append", self._arrive)

    def table(self) -> DataFrame:
        """`keys, hour, n, late`: posts in time and later ones, for each hour that has any."""
        arrived = self.arrivals.read(self.spark)
        if arrived is None:
            arrived = self.spark.createDataFrame([], self.arrivals.schema)
        counts = self.counts.read(self.spark)
        if counts is None:
            counts = self.spark.createDataFrame([], self.counts.schema)
        parts = counts.select(*self.keys, "hour", "n", (-F.col("n")).alias("late")).unionByName(
            arrived.select(*self.keys, "hour", F.lit(0).cast("bigint").alias("n"), F.col("n").alias("late"))
        )
        return parts.groupBy(*self.keys, "hour").agg(F.sum("n").alias("n"), F.sum("late").alias("late"))

    def _arrive(self, batch: DataFrame, number: int) -> None:
        hours = batch.where(F.col(self.time).isNotNull()).groupBy(*self.keys, F.window(self.time, "1 hour").alias("_hour"))
        counted = hours.agg(F.count(F.lit(1)).alias("n")).select(*self.keys, F.col("_hour.start").alias("hour"), "n")
        rows = counted.withColumn("batch", F.lit(number).cast("bigint"))
        self._store(self.arrivals, [*self.keys, "hour", "batch"])(rows, number)

    def _store(self, table: LakeTable, keys: list[str]) -> Callable[[DataFrame, int], None]:
        def store(batch: DataFrame, _: int) -> None:
            rows = batch.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
            table.update(
                batch.sparkSession, rows, lambda old, new: merge_latest(old, new, keys, ["n"], existing_is_keyed=True)
            )

        return store

    def _run(self, rows: DataFrame, name: str, mode: str, store: Callable[[DataFrame, int], None]) -> StreamingQuery:
        return run_batches(rows, f"{self.path}/checkpoint-{name}", mode, store)


class Bursts:
    """Bursts of posts, stored once they are closed: a session of a key that nothing in time can prolong."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], time: str, gap_seconds: int, delay: str):
        self.spark, self.path, self.time, self.gap_seconds, self.delay = spark, path, time, gap_seconds, delay
        self.keys = list(keys)
        names = ", ".join(f"`{k}` {t}" for k, t in keys.items())
        schema = S.schema(f"{names}, session_start timestamp_ntz, session_end timestamp_ntz, n bigint")
        by_day = {"day": lambda: F.date_format("session_start", "yyyy-MM-dd")}
        self.stored = LakeTable(f"{path}/bursts", schema, by_day, ("session_start",))

    def advance(self, read: Callable[[], DataFrame]) -> None:
        own = [*self.keys, "session_start"]

        def store(batch: DataFrame, _: int) -> None:
            times = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
            self.stored.update(
                batch.sparkSession, batch.withColumns(times),
                lambda old, new: merge_latest(old, new, own, ["n"], existing_is_keyed=True),
            )

        closed = bursts(read(), self.keys, self.time, self.gap_seconds, self.delay)
        run_batches(closed, f"{self.path}/checkpoint-bursts", "append", store)

    def table(self) -> DataFrame:
        found = self.stored.read(self.spark)
        return self.spark.createDataFrame([], self.stored.schema) if found is None else found


def run_batches(rows: DataFrame, checkpoint: str, mode: str, store: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """All that is there, as one or more batches, each handed to `store` with its number."""
    query = (
        rows.writeStream.foreachBatch(store)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
