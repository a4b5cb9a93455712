"""Run a query in Spark and its SQL in DuckDB, and compare the rows regardless of order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(plain(v) for v in row) for row in df.select(*names).collect())


def sql_rows(connection, text: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(text)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = sorted(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return sorted(names), rows


def operators(df) -> list[str]:
    """Physical operators of ``df`` one per line, not looking into tables held in memory."""

    def walk(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.initialPlan()
        yield plan.simpleString(200)
        children = plan.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))
