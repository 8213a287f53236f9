"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any size; the number of executors, their memory and
# the shuffle service belong to the cluster and are not set here.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Sort-merge joins turn into shuffled hash joins where the measured
    # partitions of one side are small, and into broadcasts below the limit.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}

# A cluster starts from many shuffle partitions and lets AQE merge them.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.speculation": "true",
}


def build_session(app_name: str = "quotelake", local_cores: int | None = None) -> SparkSession:
    """A configured session; `local_cores` selects local mode for tests and bench."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if local_cores is None:
        for key, value in CLUSTER_CONF.items():
            builder = builder.config(key, value)
    else:
        builder = (
            builder.master(f"local[{local_cores}]")
            .config("spark.sql.shuffle.partitions", str(local_cores))
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or else a folder in
    the warehouse, unless that lies on the disk of one machine of a cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    place = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    refuse_own_disk(spark.sparkContext.master, place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme())
    return os.path.join(warehouse, "_intermediate")


def refuse_own_disk(master: str, scheme: str) -> None:
    """A cluster without a shared folder would lose what one machine wrote for another."""
    if scheme == "file" and not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet. It lies in a folder of the
    application, which is deleted when the driver ends."""
    folder = os.path.join(shared_dir(spark), spark.sparkContext.applicationId)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        files.mkdirs(place)
        files.deleteOnExit(place)
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex}")
