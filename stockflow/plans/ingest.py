"""Ingest of one source: file -> raw table -> staged table, with gates, log and registry."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.config import RunContext, SourceConfig
from stockflow.operators.quality import Gate, dq_gate, dq_metrics, enforce
from stockflow.operators.standardize import clean, deduplicate, rejects, with_audit
from stockflow.session import materialized, observed
from stockflow.sources.files import (
    ORDINAL,
    OVERFLOW,
    TECHNICAL,
    check_freshness,
    read_cells,
    read_source,
)
from stockflow.sources.operations import RunResult, logged_run, register_source
from stockflow.sources.sheets import sheet_source
from stockflow.sources.tables import commit_run, ensure_schemas, run_rows, verify_write

log = logging.getLogger(__name__)


def raw_gate(columns: Sequence[str], cfg: SourceConfig) -> Gate:
    """Gate of the raw layer. Values lost when quantities are parsed are counted here,
    where the text is still at hand; they only warn. A sheet's rows without a required
    value are rejected by its own step; the staged gate checks what is left."""
    return dq_gate(
        [c for c in columns if c not in ORDINAL],
        expected=cfg.expected_columns,
        required=cfg.required_columns,
        min_rows=cfg.min_rows,
        max_rows=cfg.max_rows,
        not_null=() if cfg.src_format == "sheet" else cfg.required_columns,
        quantities=cfg.raw_quantities,
        overflow=OVERFLOW,
    )


def raw_metrics(df: DataFrame, cfg: SourceConfig) -> DataFrame:
    """The raw gate as one aggregate over ``df``."""
    gate = raw_gate(df.columns, cfg)
    return gate.report(df.agg(*(v.alias(n) for n, v in gate.values.items())))


def staged_gate(columns: Sequence[str], cfg: SourceConfig) -> Gate:
    """Gate of the staged layer, with required columns under their staged names.

    Keys are unique by the de-duplication that the rows come from; ``ingest``
    checks them on the stored copy, since a distinct count has to move keys.
    """
    return dq_gate(
        [c for c in columns if c not in TECHNICAL],
        required=cfg.staged_required,
        min_rows=cfg.min_rows,
        max_rows=cfg.max_rows,
        not_null=cfg.staged_required,
    )


def _commit(df: DataFrame, table: str, cfg: SourceConfig, ctx: RunContext) -> None:
    audited = with_audit(df.drop(*TECHNICAL), ctx)
    commit_run(df.sparkSession, audited, table, ctx, cfg.table_format)


def log_rejects(spark: SparkSession, cfg: SourceConfig, ctx: RunContext) -> None:
    """Log how many rows this run took out, by reason."""
    written = run_rows(spark, cfg.rejects_table, ctx).groupBy("reason").count()
    for row in written.collect():
        log.warning("%s: %d rows rejected as %s", cfg.source_name, row["count"], row.reason)


Seen = tuple[DataFrame, dict[str, int]]


def _watched(gate: Gate) -> dict[str, Column]:
    """The gate's aggregates, and the number of rows."""
    return gate.values | {"n_rows": F.count(F.lit(1))}


@contextmanager
def stored_source(spark: SparkSession, cfg: SourceConfig) -> Iterator[Seen]:
    """The source's rows as a stored copy, and the raw gate's values from the pass that wrote
    it; the files are read once. A sheet is stored as lines first, since its header is found
    among them."""
    with ExitStack() as stack:
        if cfg.src_format == "sheet":
            rows = sheet_source(stack.enter_context(materialized(read_cells(spark, cfg), "lines")), cfg)
        else:
            rows = read_source(spark, cfg)
        yield stack.enter_context(observed(rows, "source", _watched(raw_gate(rows.columns, cfg))))


def ingest(spark: SparkSession, cfg: SourceConfig, ctx: RunContext | None = None) -> RunResult:
    """Run one source. Raises on any failed gate; the run is logged either way.

    The file is parsed once and de-duplicated once: both results are stored,
    the gates' values are taken in the passes that store them, and the tables
    get the stored copies. Nothing is written to a layer whose gate failed. A run repeated
    under its id replaces what it wrote.
    """
    ctx = ctx or RunContext.start(cfg.src_path)
    ensure_schemas(spark)
    result = RunResult(
        ctx, cfg.notebook_type, cfg.source_name, cfg.raw_table, cfg.stg_table,
        table_format=cfg.table_format,
    )
    with logged_run(spark, result):
        check_freshness(spark, cfg, ctx.load_timestamp)
        with stored_source(spark, cfg) as (raw, seen):
            enforce(raw_gate(raw.columns, cfg).of(spark, seen), "raw")
            _commit(raw, cfg.raw_table, cfg, ctx)
            result.rows_raw = verify_write(spark, cfg.raw_table, ctx, seen["n_rows"])

            cleaned, headers = clean(raw, cfg)
            kept = deduplicate(cleaned, cfg)
            gate = staged_gate(kept.columns, cfg)
            with observed(kept, "staged", _watched(gate)) as (staged, seen):
                enforce(gate.of(spark, seen), "staged")
                if cfg.business_key:
                    enforce(dq_metrics(staged, unique_key=cfg.business_key), "staged")
                _commit(staged, cfg.stg_table, cfg, ctx)
                result.rows_stg = verify_write(spark, cfg.stg_table, ctx, seen["n_rows"])
                _commit(rejects(cleaned, headers, staged, cfg), cfg.rejects_table, cfg, ctx)
                log_rejects(spark, cfg, ctx)
        register_source(spark, cfg, result)
    return result
