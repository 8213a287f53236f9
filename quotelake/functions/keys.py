"""Key columns: composite text keys and stable surrogate ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def composite_key(*parts: str | Column, sep: str = "_", strict: bool = False) -> Column:
    """Parts joined by `sep`. NULL parts are skipped, so two different rows can
    share a key; with `strict` any NULL part makes the whole key NULL instead."""
    columns = [_col(p) for p in parts]
    key = F.concat_ws(sep, *columns)
    if not strict:
        return key
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(complete, key)


def concat_key(*parts: str | Column) -> Column:
    """Parts joined without separator; NULL as soon as one part is NULL."""
    return F.concat(*[_col(p) for p in parts])


def stable_id(*parts: str | Column) -> Column:
    """64-bit id that depends on the values only, not on partitioning or run."""
    return F.xxhash64(*[_col(p) for p in parts])


def same_key(left, right, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality over `(left column, right column)` pairs."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])
