from __future__ import annotations

from collections import Counter


def bag(df, *cols):
    """Rows as a bag of tuples."""
    return Counter(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]
