"""Entities kept up to date from raw files as they arrive.

Each run picks up all files that came since the last one, shapes them together, and
merges their rows into the entities of the feed: one batch, however many files and
sibling folders the rows are spread over. Entities that are joined from several feeds are
rebuilt for the symbols of the batch. A run that dies and repeats its batch merges
the same rows again, which changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake.operators.filters import select_posts
from quotelake.operators.merge import merge_co_located
from quotelake.operators.windows import keep_latest
from quotelake.plans.entities import ENTITIES
from quotelake.plans.feeds import FEEDS, FeedSpec, _has_files
from quotelake.session import fresh_path, remove_path
from quotelake.sources.buckets import BucketedTable


def entities_of(feed: str) -> list[str]:
    """The entities that can be built from this feed alone."""
    return [
        name
        for name, spec in ENTITIES.items()
        if spec.sources == (feed,) or (spec.any_source and feed in spec.sources)
    ]


def joined_entities_of(feed: str) -> list[str]:
    """The entities that this feed completes together with others."""
    return [n for n, spec in ENTITIES.items() if feed in spec.sources and n not in entities_of(feed)]


def feed_state(feed: str, lake_dir: str) -> BucketedTable:
    """The latest row of each symbol of a feed that entities are joined from."""
    return BucketedTable(f"{lake_dir}/_feeds/{feed}", FEEDS[feed].schema, keys=("symbol",))


def _update_joined(spark: SparkSession, feed: str, shaped: DataFrame, lake_dir: str) -> None:
    """Entities made of several feeds: the batch goes into the state of its feed, and the rows of its
    symbols are built anew from the states of all feeds."""
    wanted = joined_entities_of(feed)
    if not wanted:
        return
    rows = shaped.where("symbol is not null")
    feed_state(feed, lake_dir).update(
        spark, rows, lambda old, new: merge_co_located(old, new, ["symbol"]), lambda new: keep_latest(new, ["symbol"])
    )
    symbols = rows.select("symbol").distinct()
    for name in wanted:
        states = {}
        for source in ENTITIES[name].sources:
            known = feed_state(source, lake_dir).read(spark)
            known = spark.createDataFrame([], FEEDS[source].schema) if known is None else known
            states[source] = known.join(symbols, "symbol", "left_semi").select(*FEEDS[source].schema.fieldNames())
        ENTITIES[name].update(spark, lake_dir, ENTITIES[name].build(states))


def merge_new_files(
    spark: SparkSession,
    feed: str,
    raw_dir: str,
    lake_dir: str,
    checkpoint_dir: str,
    universe: DataFrame | None = None,
) -> StreamingQuery | None:
    """One finished `availableNow` query over all sibling folders of the feed; None if
    a feed that shows its columns by its files has none yet."""
    spec = FEEDS[feed]
    if spec.needs_universe and universe is None:
        raise ValueError(f"feed {feed} needs the ticker universe")
    source = _read_stream(spark, spec, raw_dir)
    if source is None:
        return None

    def merge(batch: DataFrame, _: int) -> None:
        rows = batch
        if spec.needs_universe:
            rows = select_posts(rows, universe, "full_text", lang=("metadata.iso_language_code", "en"))
        # Written once, since several entities and several steps of each merge read it.
        session, path = batch.sparkSession, fresh_path(batch.sparkSession, f"shaped-{feed}")
        spec.shape(rows, spec.schema).write.parquet(path)
        shaped = session.read.schema(spec.schema).parquet(path)
        for name in entities_of(feed):
            entity = ENTITIES[name]
            entity.update(session, lake_dir, entity.build({feed: shaped}))
        _update_joined(session, feed, shaped, lake_dir)
        remove_path(session, path)

    query = (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{checkpoint_dir}/{feed}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _read_stream(spark: SparkSession, spec: FeedSpec, raw_dir: str) -> DataFrame | None:
    """The raw rows of all sibling folders with their constants, without a limit on files."""
    folders = [f for f in spec.parts if f]
    path = f"{raw_dir}/{spec.name}" + (f"/{{{','.join(folders)}}}" if folders else "")
    if spec.raw is None:
        found = [f"{raw_dir}/{spec.name}/{f}" for f in folders if _has_files(spark, f"{raw_dir}/{spec.name}/{f}")]
        if not found:
            return None
        columns = spark.read.option("mergeSchema", True).parquet(*found).schema
        rows = spark.readStream.schema(columns).parquet(path)
    elif spec.raw == "value string":
        rows = spark.readStream.text(path)
    else:
        rows = spark.readStream.schema(spec.raw).option("multiLine", spec.documents).json(path)
    folder = F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1)
    constants = {}
    for name, values in spec.parts.items():
        for column, value in values.items():
            constants[column] = F.when(folder == name, F.lit(value)).otherwise(constants.get(column, F.lit(None)))
    return rows.withColumns(constants)
