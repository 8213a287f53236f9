"""Lake tables as plain parquet folders that are never changed in place.

Every update writes new folders `<table>/snapshot=<state>-<id>/...` and then publishes a small
manifest that names the folders making up the table. Readers follow the newest
manifest, so they see the old or the new state and nothing between, and a job that
dies half way leaves the old state in place. A partitioned table rewrites only the
partitions an update touches; its manifest keeps pointing at the others.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.projection import conform
from quotelake.session import fresh_path, remove_path

# Folder prefix of the versions. Spark reads it as a partition column, so no table
# may have a column of this name.
VERSION = "snapshot"
# Fixed value: the folder name that Spark gives a NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class LakeTable:
    """A stored table. `partition_by` maps partition columns to expressions over the
    table's columns; `cluster_by` is the row order inside files."""

    path: str
    schema: T.StructType
    partition_by: dict[str, Callable[[], Column]] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if VERSION in self.schema.fieldNames():
            raise ValueError(f"{VERSION} is taken by the folders of {self.path}")

    # -- reading ---------------------------------------------------------------

    def read(self, spark: SparkSession, where: Column | None = None, partitions: bool = False) -> DataFrame | None:
        """The current state, or None before the first write. `where` may use the partition
        columns, so that only folders that can match are opened; with `partitions` they are
        part of the result, for joins that are to be pruned at run time."""
        stored = self._scan(spark, self._newest(spark))
        if stored is None:
            return None
        if where is not None:
            stored = stored.where(where)
        return stored if partitions else stored.select(*self.schema.fieldNames())

    def partition_values(self, spark: SparkSession, given: dict[str, str], column: str) -> list[str]:
        """The values of a partition column, greatest first, where the others have the values `given`. They
        come from the list of folders; a partition without a value is none."""
        found = set()
        for _, folder in self._folders(spark, self._newest(spark)):
            values = dict(part.split("=", 1) for part in folder.split("/"))
            if all(values[k] == v for k, v in given.items()) and values[column] != NO_VALUE:
                found.add(values[column])
        return sorted(found, reverse=True)

    def _scan(self, spark: SparkSession, state: int) -> DataFrame | None:
        if not state:
            return None
        paths = [self._folder(f) for f in self._folders(spark, state)]
        if not paths:
            return spark.createDataFrame([], self.stored_schema())
        reader = spark.read.schema(self.stored_schema())
        if self.partition_by:
            reader = reader.option("basePath", self.path)
        return reader.parquet(*paths).select(*self.stored_schema().fieldNames())

    def stored_schema(self) -> T.StructType:
        extra = [T.StructField(c, T.StringType()) for c in self.partition_by if c not in self.schema.fieldNames()]
        return T.StructType([*self.schema.fields, *extra])

    # -- writing ---------------------------------------------------------------

    def update(
        self,
        spark: SparkSession,
        incoming: DataFrame,
        merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    ) -> int:
        """Store `merge(current rows, incoming)` as the new state; returns the number
        of rows written. For a partitioned table `merge` gets the current rows of the
        partitions that occur in `incoming` and must not move rows between
        partitions, which holds when the partition columns derive from the key."""
        state = self._newest(spark)
        current = self._scan(spark, state)
        if current is None or not self.partition_by:
            if current is not None:
                current = current.select(*self.schema.fieldNames())
            return self._write(spark, conform(merge(current, incoming), self.schema), state)
        # Both the partitions and the rows are needed, so the batch is computed and written once.
        path = fresh_path(spark, "batch")
        incoming.write.parquet(path)
        incoming = spark.read.schema(incoming.schema).parquet(path)
        current = current.where(self._touched(incoming)).select(*self.schema.fieldNames())
        rows = self._write(spark, conform(merge(current, incoming), self.schema), state)
        remove_path(spark, path)
        return rows

    def _touched(self, incoming: DataFrame) -> Column:
        """Filter for the partitions of the incoming rows. Only partition values come
        to the driver, as they do for every partitioned read."""
        columns = list(self.partition_by)
        found = incoming.select(*self._partition_columns()).distinct().collect()
        lasts: dict[tuple, list] = defaultdict(list)
        for row in found:
            lasts[tuple(row)[:-1]].append(row[columns[-1]])
        wanted = F.lit(False)
        for head, values in lasts.items():
            here = F.col(columns[-1]).isin([v for v in values if v is not None])
            if None in values:
                here = here | F.col(columns[-1]).isNull()
            for name, value in zip(columns, head):
                here = here & F.col(name).eqNullSafe(F.lit(value))
            wanted = wanted | here
        return wanted

    def _partition_columns(self) -> list[Column]:
        """Empty texts count as NULL, since a folder name cannot tell them apart."""
        return [
            F.nullif(expression().cast("string"), F.lit("")).alias(name)
            for name, expression in self.partition_by.items()
        ]

    def _write(self, spark: SparkSession, rows: DataFrame, state: int) -> int:
        version = f"{state + 1}-{uuid.uuid4().hex}"  # no two writers share a folder
        target = f"{self.path}/{VERSION}={version}"
        observed = Observation()
        out = rows.observe(observed, F.count(F.lit(1)).alias("rows"))
        if self.partition_by:
            plain = [c for c in self.schema.fieldNames() if c not in self.partition_by]
            parts = list(self.partition_by)
            out = out.select(*plain, *self._partition_columns()).hint("rebalance", *parts)
            out = out.sortWithinPartitions(*parts, *self.cluster_by)
            out.write.mode("errorifexists").partitionBy(*parts).parquet(target)
            written = self._partition_folders(spark, target)
            replaced = set(written)
            kept = [f for f in self._folders(spark, state) if f[1] not in replaced]
            folders = kept + [[version, p] for p in written]
        else:
            if self.cluster_by:
                out = out.sortWithinPartitions(*self.cluster_by)
            out.write.mode("errorifexists").parquet(target)
            folders = [[version, ""]]
        self._publish(spark, state + 1, folders)
        try:
            return observed.get["rows"]
        except Py4JJavaError:
            # A plan that Spark finds to be empty while it runs loses its observation.
            return 0

    # -- files -----------------------------------------------------------------

    def _folder(self, folder: list) -> str:
        version, partition = folder
        return f"{self.path}/{VERSION}={version}" + (f"/{partition}" if partition else "")

    def _fs(self, spark: SparkSession, path: str):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()), place

    def _list(self, spark: SparkSession, pattern: str) -> list:
        fs, place = self._fs(spark, f"{self.path}/{pattern}")
        return [status.getPath() for status in (fs.globStatus(place) or [])]

    def _states(self, spark: SparkSession) -> list[int]:
        return sorted(int(p.getName().split("-")[1]) for p in self._list(spark, "_manifest-*"))

    def _newest(self, spark: SparkSession) -> int:
        return max(self._states(spark), default=0)

    def _folders(self, spark: SparkSession, state: int) -> list[list]:
        """`[version, partition folder]` pairs that make up a state."""
        if not state:
            return []
        fs, place = self._fs(spark, f"{self.path}/_manifest-{state}")
        stream = fs.open(place)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["folders"]
        finally:
            stream.close()

    def _partition_folders(self, spark: SparkSession, target: str) -> list[str]:
        version = target.rsplit("/", 1)[1]
        found = self._list(spark, "/".join([version, *["*=*"] * len(self.partition_by)]))
        return sorted("/".join(p.toString().split("/")[-len(self.partition_by):]) for p in found)

    def _publish(self, spark: SparkSession, state: int, folders: list) -> None:
        """Make `folders` the given state. If another job has done so since the state
        before was read, its rows are not in `folders`, and this one must not win. A rename
        that refuses to overwrite is one step on HDFS; on stores where it is not, a table
        must have one writer at a time."""
        fs, draft = self._fs(spark, f"{self.path}/_draft-{uuid.uuid4().hex}")
        final = self._fs(spark, f"{self.path}/_manifest-{state}")[1]
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps({"folders": folders}).encode()))
        stream.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"{self.path} was updated by another job meanwhile; run the update again")

    def expire(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Delete folders and manifests that the newest `keep` states do not use.
        Not to be run while a job still reads or writes an older state."""
        states = self._states(spark)
        used = [f for state in states[-keep:] for f in self._folders(spark, state)]
        used_paths = {self._folder(f) for f in used}
        newest = states[-1] if states else 0
        unused = [self._fs(spark, f"{self.path}/_manifest-{state}")[1] for state in states[:-keep]]
        for place in self._list(spark, "/".join([f"{VERSION}=*", *["*=*"] * len(self.partition_by)])):
            tail = "/".join(place.toString().split("/")[-1 - len(self.partition_by):])
            made_for = int(tail.split("/")[0].split("=")[1].split("-")[0])
            if made_for <= newest and f"{self.path}/{tail}" not in used_paths:
                unused.append(place)
        for place in unused:
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        return [p.toString() for p in unused]
