"""Run log and source registry, both append-only tables."""

from __future__ import annotations

import json
import logging
import traceback
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.config import RunContext, SourceConfig
from stockflow.sources.tables import append_table

log = logging.getLogger(__name__)

RUN_LOG = "log.pipeline_runs"
REGISTRY = "cfg.source_registry_history"

# Columns of the two tables.
RUN_LOG_SCHEMA = """
    pipeline_run_id string, notebook_type string, load_date date, load_timestamp timestamp,
    source_name string, raw_table string, stg_table string, core_table string,
    out_table string, status string, rows_raw bigint, rows_stg bigint, rows_core bigint,
    rows_out bigint, executed_by string, message string
"""
REGISTRY_SCHEMA = """
    source_name string, domain string, notebook_type string, src_path string,
    src_format string, delivery_method string, refresh_cadence string,
    expected_columns string, business_key string, min_row_count bigint,
    max_row_count bigint, source_owner string, first_loaded timestamp,
    last_successful_run timestamp, last_run_id string, last_raw_row_count bigint,
    last_stg_row_count bigint, is_active boolean
"""

# Registry columns a later run replaces; all others keep their first value.
UPDATED = ("last_successful_run", "last_run_id", "last_raw_row_count", "last_stg_row_count", "src_path")


@dataclass
class RunResult:
    """What a run has written so far. A count is set only after a verified write."""

    ctx: RunContext
    notebook_type: str
    source_name: str
    raw_table: str | None = None
    stg_table: str | None = None
    core_table: str | None = None
    out_table: str | None = None
    rows_raw: int = 0
    rows_stg: int = 0
    rows_core: int = 0
    rows_out: int = 0
    table_format: str = "parquet"


def run_log_rules(runs: DataFrame) -> DataFrame:
    """Run records in table form: source tables only for source runs, counts and message
    never null."""
    is_source = F.col("notebook_type") == "source"
    rules = {c: F.when(is_source, F.col(c)) for c in ("raw_table", "stg_table")}
    rules |= {
        c: F.coalesce(F.col(c).cast("bigint"), F.lit(0))
        for c in ("rows_raw", "rows_stg", "rows_core", "rows_out")
    }
    rules["message"] = F.coalesce("message", F.lit(""))
    return runs.withColumns(rules)


def run_log_row(spark: SparkSession, result: RunResult, status: str, message: str = "") -> DataFrame:
    ctx = result.ctx
    row = (
        ctx.run_id, result.notebook_type, ctx.load_date, ctx.load_timestamp, result.source_name,
        result.raw_table, result.stg_table, result.core_table, result.out_table, status,
        result.rows_raw, result.rows_stg, result.rows_core, result.rows_out, None, message,
    )
    runs = spark.createDataFrame([row], RUN_LOG_SCHEMA)
    return run_log_rules(runs.withColumn("executed_by", F.current_user()))


@contextmanager
def logged_run(spark: SparkSession, result: RunResult) -> Iterator[RunResult]:
    """Log the run on success and on failure; a failure is always raised again."""
    try:
        yield result
    except Exception as error:
        message = f"{error} | {traceback.format_exc()}"
        try:
            _append(run_log_row(spark, result, "FAILURE", message), RUN_LOG, result)
        except Exception:
            log.exception("the failure of run %s could not be logged", result.ctx.run_id)
        raise
    _append(run_log_row(spark, result, "SUCCESS"), RUN_LOG, result)


def _append(row: DataFrame, table: str, result: RunResult) -> None:
    """Runs of different sources share these tables. Parquet has no atomic commit, so with
    it only one run at a time may append; concurrent runs need a format that has."""
    append_table(row, table, partition=None, table_format=result.table_format)


def failed_runs(runs: DataFrame, load_date=None, status: str = "FAILURE") -> DataFrame:
    """Runs with a status, newest first, for one date or for all."""
    found = runs.where(F.col("status") == status)
    if load_date is not None:
        found = found.where(F.col("load_date") == F.lit(load_date))
    return found.orderBy(F.col("load_timestamp").desc(), "pipeline_run_id")


def winning_runs(
    runs: DataFrame, table: str, keys: Sequence[str] = (), asof: datetime | None = None, layer: str = "stg_table"
) -> DataFrame:
    """``load_date, pipeline_run_id`` of the newest successful run that wrote ``table``, per ``keys``.

    The newest by load timestamp, then run id, up to ``asof``: a correction for a
    day wins on that day however late or in whatever order it was written. One
    row per key, so its size does not follow the table's.
    """
    wrote = runs.where((F.col(layer) == table) & (F.col("status") == "SUCCESS"))
    if asof is not None:
        wrote = wrote.where(F.col("load_timestamp") <= F.lit(asof))
    newest = F.max(F.struct("load_timestamp", "pipeline_run_id", "load_date")).alias("run")
    return wrote.groupBy(*keys).agg(newest).where("run IS NOT NULL").select("run.load_date", "run.pipeline_run_id")


def snapshot(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows of the winning runs. The winners, one row per key, are broadcast and prune
    the partitions of the table at run time, so other runs' files are not opened."""
    names = {"load_date": "__date", "pipeline_run_id": "__run"}
    wanted = F.broadcast(winners.withColumnsRenamed(names))
    return rows.join(wanted, [F.col(c) == F.col(w) for c, w in names.items()], "left_semi")


def register_source(spark: SparkSession, cfg: SourceConfig, result: RunResult) -> None:
    """Append this run to the registry history. A problem here never fails the run."""
    ctx = result.ctx
    row = (
        cfg.source_name, cfg.domain, cfg.notebook_type, cfg.src_path, cfg.src_format,
        cfg.delivery_method, cfg.refresh_cadence, json.dumps(list(cfg.expected_columns)),
        json.dumps(list(cfg.business_key)), cfg.min_rows, cfg.max_rows or 0, cfg.owner,
        ctx.load_timestamp, ctx.load_timestamp, ctx.run_id, result.rows_raw, result.rows_stg, True,
    )
    try:
        _append(spark.createDataFrame([row], REGISTRY_SCHEMA), REGISTRY, result)
    except Exception:
        log.warning("registry entry of %s not written", cfg.source_name, exc_info=True)


def registry_current(history: DataFrame) -> DataFrame:
    """One row per source: first values of what is frozen, last values of what is updated.

    The history replaces an in-place update, so any table format will do.
    """
    age = F.struct("last_successful_run", "last_run_id")
    frozen = [c for c in history.columns if c not in (*UPDATED, "source_name", "first_loaded")]
    first = F.min_by(F.struct(*frozen), age)
    last = F.max_by(F.struct(*UPDATED), age)
    return (
        history.groupBy("source_name")
        .agg(
            F.min("first_loaded").alias("first_loaded"), first.alias("first"), last.alias("last")
        )
        .select("source_name", "first_loaded", "first.*", "last.*")
        .select(*history.columns)
    )
