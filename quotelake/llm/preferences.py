"""Preference formatting: a chosen and a rejected conversation as one prompt and two completions.

The prompt is the longest run of first turns that both conversations share, rendered once; what
follows in each is its completion, with a mask of the characters that are trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks around a turn in the chat format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SPANS = "array<struct<start:int,stop:int>>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def _mask(turns: Column, role: str) -> Column:
    """Where the texts of `role`, with their closing marks, stand in the rendered turns."""

    def step(done, turn):
        start = done["at"] + F.length(_head(turn))
        stop = start + F.length(turn["text"]) + F.lit(len(CLOSE))
        span = F.array(F.struct(start.alias("start"), stop.alias("stop"))).cast(SPANS)
        spans = F.when(turn["role"] == role, F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct(stop.cast("int").alias("at"), spans.alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(turns, none, step, lambda done: done["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id", trained_role: str = "assistant") -> DataFrame:
    """One row for each `key` that is in both tables (`key, turn, role, text`).

    `shared_turns`; `prompt`, the shared first turns; `chosen` and `rejected`, the turns after them;
    `chosen_mask` and `rejected_mask`, arrays of `start, stop` for the characters of the completion
    that are trained on: the texts of the trained role with their closing marks, not the role lines.

    Turns are shared if role and text are equal; if one conversation begins the other, its
    completion is empty. Turns with the same number are ordered by role and text, and a null number
    comes first; null roles and texts count as empty; repeated rows are turns of their own. Rows with
    a null key belong to no pair. Other columns are not read. A conversation becomes one row, so a
    task holds whole conversations, one pair at a time.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    both = None
    for side, df in enumerate((chosen, rejected)):
        own = df.where(F.col(key).isNotNull()).select(key, F.lit(side).alias("side"), turn.alias("t"))
        both = own if both is None else both.union(own)

    def turns(side):
        return F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("t")))).alias(f"turns_{side}")

    pairs = both.groupBy(key).agg(turns(0), turns(1)).where("size(turns_0) > 0 and size(turns_1) > 0")
    a, b = F.col("turns_0"), F.col("turns_1")
    # Whether each pair of turns at one place differs; the first that does ends the prompt.
    differs = F.zip_with(a, b, lambda x, y: ~(x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])))
    first = F.array_position(differs, True)
    shared = F.when(first > 0, first - 1).otherwise(F.size(a)).cast("int")
    cut = pairs.withColumn("shared_turns", shared)
    rest = [F.slice(t, F.col("shared_turns") + 1, F.size(t)) for t in (a, b)]
    return cut.select(
        key, "shared_turns", _rendered(F.slice(a, F.lit(1), F.col("shared_turns"))).alias("prompt"),
        _rendered(rest[0]).alias("chosen"), _mask(rest[0], trained_role).alias("chosen_mask"),
        _rendered(rest[1]).alias("rejected"), _mask(rest[1], trained_role).alias("rejected_mask"),
    )
