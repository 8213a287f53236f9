"""Text to typed values. All of these return NULL for bad text and never raise,
also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value in the payloads.
MISSING_TEXTS = ("", "NaN", "nan", "None")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: str | Column) -> Column:
    column = _col(c)
    return F.when(~F.trim(column).isin(*MISSING_TEXTS), column)


WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def to_number(c: str | Column, type_name: str = "double") -> Column:
    """The number a text holds. Whole types also take whole numbers written as floats
    (`1234.0`, `5e9`), as dumps of columns with gaps have them, without loss of digits."""
    trimmed = F.trim(_col(c))
    if type_name in WHOLE_TYPES:
        exact = trimmed.try_cast("decimal(38,6)")
        value = F.when(exact == F.floor(exact), exact).try_cast(type_name)
    else:
        value = trimmed.try_cast(type_name)
    return F.when(~trimmed.isin(*MISSING_TEXTS), value)


def parse_percent(c: str | Column, type_name: str = "double") -> Column:
    """`'0.12%'` -> 0.12; percent signs are taken off both ends."""
    return to_number(F.btrim(_col(c), F.lit("%")), type_name)
