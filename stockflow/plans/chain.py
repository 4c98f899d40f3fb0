"""The whole day as one run: source files -> staged -> crosswalk and orders in transit -> core -> upload.

Each step is a run of its own under an id made from the chain's, so a chain that
is repeated under its id replaces what its steps wrote and nothing else. Domains
that later steps share, the crosswalk and the orders in transit, are stored once
with the run that made them and read back as of that run.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from stockflow.config import DEFAULT_COMPANIES, RunContext, SourceConfig
from stockflow.operators.distributor import append_sources
from stockflow.operators.quality import dq_metrics, enforce
from stockflow.operators.standardize import with_audit
from stockflow.plans import erp, supply
from stockflow.plans.ingest import ingest
from stockflow.plans.publish import PublishConfig, publish_upload
from stockflow.session import materialized
from stockflow.sources.operations import RUN_LOG, RunResult, logged_run, snapshot, winning_runs
from stockflow.sources.tables import commit_run, ensure_schemas, run_rows

log = logging.getLogger(__name__)

AUDIT = ("load_date", "load_timestamp", "src_file_name", "pipeline_run_id")


@dataclass(frozen=True)
class ChainConfig:
    """Settings of a chain.

    ``keep_previous`` lets the chain go on with a source's last staged rows when
    its own run fails; otherwise the failure stops it. ``transit_days`` switches
    orders in transit on.
    """

    sources: tuple[SourceConfig, ...]
    publish: PublishConfig = field(default_factory=PublishConfig)
    companies: tuple[str, ...] = DEFAULT_COMPANIES
    rank_by: str = "cross_reference"
    crosswalk_table: str = "core.sku_crosswalk"
    transit_table: str = "core.in_transit"
    transit_days: int | None = None
    keep_previous: bool = False
    schema: str = "scut"


@dataclass
class ChainResult:
    """What the steps wrote; ``failed`` has the sources whose own run failed."""

    ctx: RunContext
    sources: dict[str, RunResult]
    crosswalk: RunResult
    transit: RunResult | None
    upload: RunResult
    failed: dict[str, Exception]
    path: str


def store_domain(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    ctx: RunContext,
    table_format: str = "parquet",
    min_rows: int = 1,
) -> RunResult:
    """Store a shared domain with this run. Only a run that is logged as a success is a
    version, so one with fewer than ``min_rows`` rows is never read back."""
    result = RunResult(ctx, "core", table.split(".")[-1], core_table=table, table_format=table_format)
    ensure_schemas(spark)
    with logged_run(spark, result):
        commit_run(spark, with_audit(rows, ctx), table, ctx, table_format)
        written = run_rows(spark, table, ctx)
        enforce(dq_metrics(written, min_rows=min_rows), table)
        result.rows_core = written.count()
    return result


def domain_as_of(spark: SparkSession, table: str, asof: datetime) -> DataFrame:
    """The newest version of a stored domain that was there at ``asof``, without audit columns."""
    winners = winning_runs(spark.table(RUN_LOG), table, asof=asof, layer="core_table")
    return snapshot(spark.table(table), winners).drop(*AUDIT)


def staged_inventory(spark: SparkSession, sources: tuple[SourceConfig, ...], asof: datetime) -> DataFrame:
    """All sources' newest staged rows as of a time, appended under the standard names.

    A source that never had a successful run up to then is an error.
    """
    runs = spark.table(RUN_LOG)
    frames = {}
    for cfg in sources:
        winners = winning_runs(runs, cfg.stg_table, asof=asof)
        if winners.isEmpty():
            raise ValueError(f"{cfg.source_name} has no staged rows as of {asof}")
        frames[cfg.source_name] = snapshot(spark.table(cfg.stg_table), winners)
    return append_sources(frames)


def run_chain(
    spark: SparkSession,
    cfg: ChainConfig,
    root: str,
    ctx: RunContext | None = None,
    buylist: Callable[[], DataFrame] | None = None,
    orders: Callable[[], DataFrame] | None = None,
) -> ChainResult:
    """Run all steps; the upload goes to a folder of this run below ``root``.

    ``buylist`` and ``orders`` give the two ERP frames; by default they come from
    the tables of ``cfg.schema``, orders cut to the days in transit.
    """
    ctx = ctx or RunContext.start(root)
    ensure_schemas(spark)
    done, failed = {}, {}
    for source in cfg.sources:
        try:
            done[source.source_name] = ingest(spark, source, ctx.part(source.source_name, source.src_path))
        except Exception as error:
            if not cfg.keep_previous:
                raise
            failed[source.source_name] = error
            log.warning("%s failed; its previous rows are used", source.source_name, exc_info=True)

    buylist = buylist or (lambda: erp.buylist_detail(erp.catalog_tables(spark, erp.BUYLIST_TABLES, cfg.schema)))
    asof, fmt = ctx.load_timestamp, cfg.publish.table_format
    xwalk = supply.crosswalk(buylist(), cfg.companies, cfg.rank_by)
    stored = store_domain(spark, cfg.crosswalk_table, xwalk, ctx.part("crosswalk"), fmt)
    xwalk = domain_as_of(spark, cfg.crosswalk_table, asof)

    moving = moved = None
    if cfg.transit_days is not None:
        with ExitStack() as stack:
            found = orders() if orders else requested_orders(spark, cfg, ctx, stack)
            lines = supply.in_transit(found, xwalk, ctx.load_date, cfg.transit_days)
            moved = store_domain(spark, cfg.transit_table, lines, ctx.part("transit"), fmt, min_rows=0)
        moving = domain_as_of(spark, cfg.transit_table, asof)

    inventory = staged_inventory(spark, cfg.sources, asof)
    path = f"{root.rstrip('/')}/load_date={ctx.load_date}/run={ctx.run_id}"
    upload = publish_upload(
        spark, cfg.publish, inventory, xwalk, path, moving, ctx.part("upload", path), replace=True
    )
    return ChainResult(ctx, done, stored, moved, upload, failed, path)


def requested_orders(spark: SparkSession, cfg: ChainConfig, ctx: RunContext, stack: ExitStack) -> DataFrame:
    """Orders of the days in transit from the tables of ``cfg.schema``; the lines that
    qualify are stored until ``stack`` ends."""
    tables = erp.catalog_tables(spark, erp.ORDER_TABLES, cfg.schema)
    first = ctx.load_date - timedelta(days=cfg.transit_days)
    return erp.orders_requested(
        tables, first, ctx.load_date, lambda rows: stack.enter_context(materialized(rows, "requested"))
    )
