"""Timestamps, day texts and epoch seconds.

Day and second texts come from casts, which leave a zone-less timestamp alone
whatever the session time zone is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_text(c: str | Column) -> Column:
    """Timestamp, or text that starts like one -> `yyyy-MM-dd`. Of a text it is the
    day as written, whatever zone follows; NULL if the text is no date."""
    return _col(c).try_cast("date").cast("string")


def second_text(c: str | Column) -> Column:
    """Timestamp or ISO text -> `yyyy-MM-dd HH:mm:ss` as written, fractions and zone cut
    off; NULL if the text is no time."""
    return F.substring(_col(c).cast("string").try_cast("timestamp_ntz").cast("string"), 1, 19)


def text_to_day(c: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text timestamp -> day text; NULL where the text does not fit the pattern."""
    return day_text(F.try_to_timestamp(_col(c), F.lit(pattern)))


def epoch_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds (number or text) -> UTC wall-clock timestamp without zone."""
    seconds = _col(c).try_cast("bigint").try_cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds)
