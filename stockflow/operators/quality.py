"""Data-quality gates.

All checks of a layer are one aggregate: ``dq_metrics`` gives one row per check
as ``(check_name, column_name, value, status)`` and ``enforce`` raises on FAIL.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.numbers import lost_in_parse
from stockflow.functions.text import normalized_key

log = logging.getLogger(__name__)

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


class DataQualityError(ValueError):
    """A gate failed; nothing of the layer may be written."""


class Gate(NamedTuple):
    """Checks as aggregates to be computed wherever the rows pass, and what they say.

    ``values`` are aggregates by name. ``rows`` gives a check's line from them.
    """

    values: dict[str, Column]
    rows: list[Column]

    def report(self, one: DataFrame) -> DataFrame:
        """One row per check from the row of computed values."""
        return one.select(F.inline(F.array(*self.rows)))

    def of(self, spark: SparkSession, seen: Mapping[str, int]) -> DataFrame:
        """The same from values that were observed while the rows were written."""
        kinds = ", ".join(f"{name} long" for name in self.values)
        return self.report(spark.createDataFrame([tuple(seen[name] for name in self.values)], kinds))


def dq_metrics(df: DataFrame, **checks) -> DataFrame:
    """The checks of ``dq_gate`` in one aggregate over ``df``."""
    gate = dq_gate(df.columns, **checks)
    return gate.report(df.agg(*(v.alias(n) for n, v in gate.values.items())))


def dq_gate(
    names: Sequence[str],
    *,
    expected: Sequence[str] = (),
    required: Sequence[str] = (),
    min_rows: int | None = None,
    max_rows: int | None = None,
    not_null: Sequence[str] = (),
    unique_key: Sequence[str] = (),
    quantities: Sequence[str] = (),
    overflow: str | None = None,
) -> Gate:
    """Checks in gate order: columns, row count, nulls, key uniqueness, lost quantities, long lines.

    A column check reports how many values the column holds; with ``expected``
    it also warns of columns not in the list. ``not_null`` and
    ``quantities`` skip columns that are absent; their absence is the column
    check's finding.
    """
    present = set(names)
    columns = [c for c in names if c != overflow]
    values: dict[str, Column] = {}
    rows: list[Column] = []

    def metric(check: str, column: str | None, value: Column, status: Column | str) -> None:
        name = f"m{len(values)}"
        values[name] = value
        rows.append(
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(column).cast("string").alias("column_name"),
                F.col(name).cast("bigint").alias("value"),
                (F.lit(status) if isinstance(status, str) else status).alias("status"),
            )
        )

    def this() -> Column:
        return F.col(f"m{len(values)}")

    if expected or required:
        unexpected = columns if expected else ()
        for column in dict.fromkeys((*expected, *required, *unexpected)):
            if column in present:
                status = PASS if column in expected or column in required else WARN
                metric("columns", column, F.count(F.col(column)), status)
            else:
                metric("columns", column, F.lit(0), FAIL if column in required else WARN)
    if min_rows is not None:
        status = F.when(this() < min_rows, FAIL)
        if max_rows:
            status = status.when(this() > max_rows, WARN)
        metric("row_count", None, F.count(F.lit(1)), status.otherwise(PASS))
    for column in not_null:
        if column in present:
            status = F.when(this() > 0, FAIL).otherwise(PASS)
            metric("nulls", column, F.count_if(F.col(column).isNull()), status)
    if unique_key:
        status = F.when(this() > 0, FAIL).otherwise(PASS)
        # A struct is never null, so keys with null parts are counted, and equal each other.
        repeats = F.count(F.lit(1)) - F.count_distinct(F.struct(*unique_key))
        metric("unique_key", ",".join(unique_key), repeats, status)
    for column in quantities:
        if column in present:
            status = F.when(this() > 0, WARN).otherwise(PASS)
            metric("lost_quantity", column, F.count_if(lost_in_parse(F.col(column))), status)
    if overflow in present:
        status = F.when(this() > 0, FAIL).otherwise(PASS)
        metric("malformed", None, F.count_if(F.col(overflow).isNotNull()), status)

    return Gate(values, rows)


def enforce(metrics: DataFrame, layer: str = "") -> None:
    """Log warnings and raise if any check failed. The metrics are one row per check."""
    failed = []
    for m in metrics.where(F.col("status") != PASS).collect():
        text = f"{layer} {m.check_name} {m.column_name or ''}: {m.value}".strip()
        log.warning("%s %s", m.status, text)
        if m.status == FAIL:
            failed.append(text)
    if failed:
        raise DataQualityError("; ".join(failed))


def match_rate(df: DataFrame, col: str, threshold: float = 0.8) -> DataFrame:
    """Share of rows whose ``col`` was found, as one row with the gate's verdict.

    Without rows the rate is null and the gate fails.
    """
    one = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.col(col)).alias("n_matched"),
    )
    rate = F.when(F.col("n_rows") > 0, F.col("n_matched") / F.col("n_rows"))
    status = F.when(rate >= threshold, PASS).otherwise(FAIL)
    return one.select("*", F.round(rate, 6).alias("match_rate"), status.alias("status"))


def enforce_match_rate(rate: DataFrame) -> None:
    row = rate.first()
    if row.status == FAIL:
        reasons = f": {row.reasons}" if "reasons" in rate.columns and row.reasons else ""
        raise DataQualityError(f"match rate {row.match_rate} ({row.n_matched} of {row.n_rows}){reasons}")


def near_miss(
    unmatched: DataFrame, crosswalk: DataFrame, on: Sequence[tuple[str, str]], code: str
) -> DataFrame:
    """Unmatched keys that would match after trimming, upper-casing and dropping leading zeros.

    Both sides are reduced to one row per (normalised) key before they meet.
    """
    left, right = [l for l, _ in on], [r for _, r in on]
    misses = unmatched.groupBy(*left).agg(F.count(F.lit(1)).alias("n_rows"))
    misses = misses.withColumns({f"__n{i}": normalized_key(F.col(l)) for i, l in enumerate(left)})
    near = crosswalk.groupBy(
        *(normalized_key(F.col(r)).alias(f"__n{i}") for i, r in enumerate(right))
    ).agg(
        F.min(code).alias("candidate"),
        F.count_distinct(code).alias("n_candidates"),
    )
    return misses.join(near, [f"__n{i}" for i in range(len(on))]).select(
        *left, "n_rows", "candidate", "n_candidates"
    )
