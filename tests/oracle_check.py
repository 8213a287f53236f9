"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{os.path.join(folder, name)}.parquet'")
    return con


def _normal(value):
    if isinstance(value, float):
        return None if value != value else round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_normal(row[i]) for i in order) for row in rows)


def kind(type_name):
    """Coarse type class, so that the schemas of both engines can be compared."""
    name = str(type_name).lower()
    for prefix, coarse in (
        ("decimal", "decimal"), ("timestamp", "timestamp"), ("varchar", "string"), ("string", "string"),
        ("bigint", "bigint"), ("hugeint", "hugeint"), ("int", "int"), ("double", "double"), ("bool", "boolean"),
    ):
        if name.startswith(prefix):
            return coarse
    return name


def compare(spark, con, folder, run, sql):
    """None if both agree, else what differs."""
    df = run(spark, folder)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: kind(d[1]) for d in result.description}
    theirs = _rows(names, result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    wrong = {c: (kind(t), types[c]) for c, t in df.dtypes if kind(t) != types[c]}
    if wrong:
        return f"types {wrong}"
    if mine[1] != theirs[1]:
        only_mine, only_theirs = mine[1] - theirs[1], theirs[1] - mine[1]
        return f"{sum(mine[1].values())} rows != {sum(theirs[1].values())}: {list(only_mine)[:2]} / {list(only_theirs)[:2]}"
    if not mine[1]:
        return "no rows"
    return None
