"""One row per key, and what is left over.

Every "keep one" is ``row_number() = 1`` under a declared total order. Catalyst
plans that as a group limit before and after the shuffle, so each map task
sends at most one row per key and a hot key never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.operators.joins import lookup

_RANK = "__rank"


class Split(NamedTuple):
    """Rows that stay, and rows taken out with a ``reason``."""

    kept: DataFrame
    rejected: DataFrame


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``; null keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_by(
    df: DataFrame, keys: Sequence[str], latest: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Row with the greatest ``latest`` per key; nulls are oldest, ``ties`` decide equal values."""
    return last_by(df, keys, (latest, *ties))


def dedupe_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: str
) -> Split:
    """Keep the last row of each key under ``order``; the others are rejects.

    ``row_id`` is unique and not null.
    """
    kept = last_by(df, keys, order)
    return Split(kept, repeats(df, kept, row_id))


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


def repeats(df: DataFrame, kept: DataFrame, row_id: str) -> DataFrame:
    """Rows that were not kept. The anti join on a unique column spreads evenly however
    many rows one key holds; a window over the key would gather them in one task."""
    rest = df.join(kept.select(row_id), row_id, "left_anti")
    return rest.withColumn("reason", F.lit("DUPLICATE_KEY"))


def first_match(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    order: Sequence[Column],
    cols: Sequence[str],
) -> DataFrame:
    """Left join that brings ``cols`` of the first matching right row, so no left
    row is ever multiplied. Null keys do not match."""
    keys = [r for _, r in on]
    best = first_by(all_present(right, keys), keys, order).select(
        *(F.col(k).alias(f"__{k}") for k in keys), *cols
    )
    found = lookup(left, best, [(l, f"__{r}") for l, r in on])
    return found.drop(*(f"__{k}" for k in keys))


def null_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What "one row per key" does to rows whose key has a null part: how many there are,
    in how many groups they fall, and how many rows are lost to that. One row."""
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    groups = df.where(no_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    counts = groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), F.count("__n").alias("n_groups")
    )
    return counts.withColumn("n_lost", F.col("n_rows") - F.col("n_groups"))


def all_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def latest_snapshot(
    df: DataFrame,
    keys: Sequence[str] = ("load_date",),
    run: str = "pipeline_run_id",
    ts: str = "load_timestamp",
) -> DataFrame:
    """Rows of the newest run per key of an append-only table, as the table is when they are read.

    The winners are one row per key: the newest time per run first (a hash
    aggregate over the rows), then the newest run per key over that small
    result. Keys and run ids are compared with nulls equal. Adaptive execution
    broadcasts the winners if it measures them to be small.
    """
    runs = df.groupBy(*keys, run).agg(F.max(ts).alias("__newest"))
    winners = runs.groupBy(*keys).agg(
        F.max(F.struct("__newest", run)).getField(run).alias("__run")
    )
    winners = winners.select(*(F.col(k).alias(f"__{k}") for k in keys), "__run")
    match = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(winners, [*match, F.col(run).eqNullSafe(F.col("__run"))], "left_semi")
