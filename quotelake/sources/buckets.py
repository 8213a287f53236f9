"""Lake tables whose rows are dealt into buckets by a hash of their key.

Both the stored rows and a batch are written as Spark's own bucketed files, so a merge joins them
bucket by bucket: neither side is moved, and only buckets that the batch falls into are read and
rewritten. Keys without any order in time (news ids, user ids) are stored this way; what has
one is better partitioned by it, since an update then touches few partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.projection import conform
from quotelake.session import fresh_path, remove_path
from quotelake.sources.snapshots import VERSION, LakeTable

BUCKET = "bucket"
#: Partitions that one statement adds to the catalog.
AT_ONCE = 500


@dataclass(frozen=True)
class BucketedTable(LakeTable):
    """`keys` identify a row. `buckets` holds for a new table; one that exists keeps its own number, which
    is part of its folder names. A bucket should come to some hundred megabytes."""

    keys: tuple[str, ...] = ()
    buckets: int = 64

    def __post_init__(self) -> None:
        super().__post_init__()
        if BUCKET in self.schema.fieldNames():
            raise ValueError(f"{BUCKET} is taken by the folders of {self.path}")
        if not self.keys:
            raise ValueError(f"{self.path} has no key to deal its rows by")
        # Folders are one level deep, as of a table with one partition column.
        object.__setattr__(self, "partition_by", {BUCKET: lambda: bucket_of(self.keys, self.buckets)})

    def find(self, spark: SparkSession, key: dict[str, object]) -> DataFrame | None:
        """The rows with this key; only their bucket is read."""
        if set(key) != set(self.keys):
            raise ValueError(f"a key has the columns {self.keys}")
        kinds = {f.name: f.dataType for f in self.schema.fields}
        given = {k: F.lit(v).cast(kinds[k]) for k, v in key.items()}
        place = F.pmod(F.hash(*[given[k] for k in self.keys]), F.lit(self.count(spark))).cast("string")
        wanted = F.col(BUCKET) == place
        for name, value in given.items():
            wanted = wanted & F.col(name).eqNullSafe(value)
        return self.read(spark, wanted)

    def count(self, spark: SparkSession) -> int:
        """The number of buckets of the stored table, or that of a new one."""
        return self._count(self._folders(spark, self._newest(spark)))

    def _count(self, folders: list[list]) -> int:
        return int(folders[0][0].rsplit("-of-", 1)[1]) if folders else self.buckets

    def update(
        self,
        spark: SparkSession,
        incoming: DataFrame,
        merge: Callable[[DataFrame | None, DataFrame], DataFrame],
        latest: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> int:
        """Store `merge(current rows, latest(incoming))` of the buckets that the batch falls into.

        `latest` leaves one row for each key of the batch. `merge` gets both sides as bucketed scans;
        joined by plain equality of all keys (`merge_co_located`), neither is shuffled or broadcast.
        Returns the number of rows written.
        """
        state = self._newest(spark)
        folders = self._folders(spark, state)
        count = self._count(folders)
        target = f"{self.path}/{VERSION}={state + 1}-{uuid.uuid4().hex}-of-{count}"
        batch = target if not folders else fresh_path(spark, "batch")
        rows = latest(conform(incoming, self.schema))
        # One file for each bucket; this moves the batch only.
        self._save(spark, rows.repartition(count, *self.keys), batch, count)
        if folders:
            touched = self._bucket_folders(spark, batch)
            current = [self._folder(f) for f in folders if f[1] in touched]
            fresh = [f"{batch}/{p}" for p in touched]
            with self._scanned(spark, current, count) as old, self._scanned(spark, fresh, count) as new:
                self._save(spark, merge(old, new), target, count)
            remove_path(spark, batch)
        written = self._bucket_folders(spark, target)
        replaced, version = set(written), target.rsplit("=", 1)[1]
        kept = [f for f in folders if f[1] not in replaced]
        self._publish(spark, state + 1, kept + [[version, p] for p in written])
        if not written:
            return 0
        return spark.read.schema(self.schema).parquet(*[f"{target}/{p}" for p in written]).count()  # from the file footers

    def _bucket_folders(self, spark: SparkSession, path: str) -> list[str]:
        files, place = self._fs(spark, f"{path}/{BUCKET}=*")
        return sorted(status.getPath().getName() for status in (files.globStatus(place) or []))

    def _save(self, spark: SparkSession, rows: DataFrame, path: str, count: int) -> None:
        placed = rows.select(*self.schema.fieldNames()).withColumn(BUCKET, bucket_of(self.keys, count))
        name = _name()
        writer = placed.write.format("parquet").partitionBy(BUCKET).bucketBy(count, *self.keys).sortBy(*self.keys)
        try:
            writer.option("path", path).saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay

    @contextmanager
    def _scanned(self, spark: SparkSession, folders: list[str], count: int) -> Iterator[DataFrame]:
        """A scan of bucket folders of any versions that knows their buckets. It stands in the catalog
        as long as it is in use, since only tables of the catalog are read by bucket."""
        name, keys = _name(), ", ".join(f"`{k}`" for k in self.keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
            f"CLUSTERED BY ({keys}) INTO {count} BUCKETS LOCATION {_quoted(self.path)}"
        )
        try:
            for i in range(0, len(folders), AT_ONCE):
                parts = [f"PARTITION ({f.rsplit('/', 1)[1]}) LOCATION {_quoted(f)}" for f in folders[i : i + AT_ONCE]]
                spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts)}")
            yield spark.table(name).select(*self.schema.fieldNames())
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucket_of(keys: tuple[str, ...], count: int) -> Column:
    """The bucket that Spark deals a row into when it writes bucketed files."""
    return F.pmod(F.hash(*[F.col(f"`{k}`") for k in keys]), F.lit(count))


def _name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
