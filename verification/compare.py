"""Compare a Spark result with its SQL check: columns, types of values, and rows as a bag."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _bag(rows, order) -> Counter:
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    want = _bag(found.fetchall(), sorted(range(len(names)), key=lambda i: names[i]))
    got = _bag(df.collect(), sorted(range(len(names)), key=lambda i: df.columns[i]))
    if want == got:
        return ""
    missing, extra = list((want - got).elements()), list((got - want).elements())
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"missing {len(missing)} e.g. {missing[:1]}; extra {len(extra)} e.g. {extra[:1]}"
    )
