"""Repeated byte strings by rounds of ranks, position by position.

Every position gets the rank of its first bytes; a round pairs the rank of a position with that of the
position one window further, so windows grow from 8 bytes to 16, 32, 64 and the asked length, and
Spark ranks the pairs anew. Positions whose window is unique drop out: no longer one there repeats.

This is the method without any thinning: all positions of the corpus travel in the first rounds. It
gives the same result as `suffix_dedup.remove_repeats`, which the query uses; the README has the figures of both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.shared import stored, text_runs
from quotelake.llm.suffix_dedup import CUT_SCHEMA, cut_ranges, documents, has_no_id, with_their_ids
from quotelake.operators.windows import with_group_stats

FIRST = 8
RUN_BYTES = 1 << 20
PLACE = ["doc_id", "tie", "at"]


def _prefixes(batches):
    """The first eight bytes of each position as one number."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for own in text_runs(texts, RUN_BYTES):
            for i in range(own.start, own.stop):
                data = np.frombuffer((texts[i] or "").encode(), np.uint8)
                if len(data) < FIRST:
                    continue
                name = np.lib.stride_tricks.sliding_window_view(data, FIRST).copy().view(np.int64).ravel()
                keys = [pa.array([batch.column(c)[i].as_py()] * len(name), t) for c, t in (("doc_id", pa.int64()), ("tie", pa.int32()))]
                yield pa.record_batch([*keys, pa.array(np.arange(len(name), dtype=np.int32)), pa.array(name)], [*PLACE, "name"])


def _repeated(rows: DataFrame, *names: str) -> DataFrame:
    """Positions that share their `names` with others, and the rank they share: the least number of one of them."""
    ranked = with_group_stats(rows, list(names), {"rank": F.min("number"), "times": F.count(F.lit(1))})
    return ranked.where("times > 1").select(*PLACE, "number", F.col("rank").alias("name"))


def remove_repeats_by_ranks(docs: DataFrame, length: int = 100) -> DataFrame:
    """As `suffix_dedup.remove_repeats`, for lengths of 8 bytes and more."""
    if length < FIRST:
        raise ValueError(f"length must be {FIRST} at least")
    source = documents(docs)
    positions = source.mapInArrow(_prefixes, "doc_id bigint, tie int, at int, name bigint")
    held = stored(positions.withColumn("number", F.monotonically_increasing_id()), "positions")
    held, size = stored(_repeated(held, "name"), "ranks"), FIRST
    while size < length:
        step = min(size, length - size)
        further = held.select("doc_id", "tie", (F.col("at") - step).alias("at"), F.col("name").alias("second"))
        held, size = stored(_repeated(held.join(further, PLACE), "name", "second"), "ranks"), size + step
    place = F.struct((~has_no_id()).alias("known"), *PLACE)
    ordered = with_group_stats(held.withColumn("place", place), ["name"], {"first": F.min("place")})
    later = ordered.where("place > first")
    # Positions next to each other become one range.
    in_text = Window.partitionBy("doc_id", "tie").orderBy("at")
    begins = F.when(F.col("at") <= F.lag("at").over(in_text) + length, 0).otherwise(1)
    numbered = later.withColumn("begins", begins).withColumn("range", F.sum("begins").over(in_text))
    ranges = numbered.groupBy("doc_id", "tie", "range").agg(F.min("at").alias("start"), (F.max("at") + length).alias("stop"))
    per_text = ranges.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    whole = source.join(per_text, ["doc_id", "tie"], "left").select("doc_id", "tie", "text", "ranges")
    return with_their_ids(whole).mapInArrow(cut_ranges, CUT_SCHEMA)
