"""Matrix payloads to rows, label/value rows to columns, arrays to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_matrix(
    df: DataFrame,
    index: list[str],
    fields: list[str],
    ticker: str = "ticker",
    sep: str = "_",
) -> DataFrame:
    """Columns named `<ticker><sep><field>` -> one row per index row and ticker.

    The tickers are read off the column names. Each input row already holds all
    fields of all its tickers, so the `stack` generator does it row by row: no
    grouping and no shuffle. A ticker without any value in a row gives no row.
    """
    types = dict(df.dtypes)
    endings = [f"{sep}{f}" for f in fields]
    series = [c for c in df.columns if c not in index]
    tickers = list(dict.fromkeys(c[: -len(e)] for c in series for e in endings if c.endswith(e)))
    if not tickers:
        raise ValueError(f"no column ends with one of {endings}")
    # A field has one type over all tickers; a ticker may lack a field.
    kinds = {e: next((types[t + e] for t in tickers if t + e in types), "double") for e in endings}

    def bar(name: str) -> str:
        values = [_quoted(name + e) if name + e in types else f"cast(null as {kinds[e]})" for e in endings]
        return ", ".join([_literal(name), *values])

    # One SQL text: with hundreds of tickers, building the columns one by one in
    # Python would take longer than the query.
    names = ", ".join(_quoted(c) for c in (ticker, *fields))
    bars = df.selectExpr(
        *[_quoted(c) for c in index], f"stack({len(tickers)}, {', '.join(bar(t) for t in tickers)}) as ({names})"
    )
    missing = {
        f: F.nanvl(F.col(f"`{f}`"), F.lit(None).cast(kinds[e]))
        for f, e in zip(fields, endings)
        if kinds[e] in ("double", "float")
    }
    any_value = reduce(lambda a, b: a | b, [F.col(f"`{f}`").isNotNull() for f in fields])
    return bars.withColumns(missing).where(any_value)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pivot_labels(df: DataFrame, ids: list[str], label: str, value: str, labels: list[str]) -> DataFrame:
    """Label/value rows -> one row per `ids` with a column per label.

    The label list is fixed, so the result schema does not depend on the data, and
    conditional maxima aggregate before the one shuffle on `ids`.
    """
    return df.groupBy(*ids).agg(*[_pick(label, x, value).alias(x) for x in labels])


def transpose_statement(
    df: DataFrame,
    ids: list[str],
    metric: str,
    metrics: list[str],
    date: str = "date",
    dates: list[str] | None = None,
) -> DataFrame:
    """Metric rows with one column per date -> one row per date with a column per
    metric. A date without any value for an id gives no row, since a date column
    of a wide frame need not belong to every id."""
    dates = dates or [c for c in df.columns if c not in (*ids, metric)]
    long = df.unpivot([*ids, metric], dates, date, "_value").where(F.col("_value").isNotNull())
    return pivot_labels(long, [*ids, date], metric, "_value", metrics)


def _pick(label: str, wanted: str, value: str) -> Column:
    return F.max(F.when(F.col(label) == wanted, F.col(value)))


def explode_array(df: DataFrame, keep: list[str], array: str, item: str) -> DataFrame:
    """One row per distinct item of the array; NULL and empty arrays give none.
    Repeats within one array are dropped before the rows are made."""
    return df.select(*keep, F.explode(F.array_distinct(F.col(array))).alias(item))


def explode_structs(df: DataFrame, keep: list[str], array: str, fields: dict[str, str]) -> DataFrame:
    """One row per struct of the array with `{field: output name}` projected."""
    return df.select(*keep, F.explode(array).alias("_item")).select(
        *keep, *[F.col(f"_item.{f}").alias(name) for f, name in fields.items()]
    )


def array_field(array: str | Column, field: str) -> Column:
    """Array of structs -> array of one field."""
    column = F.col(array) if isinstance(array, str) else array
    return column.getField(field)
