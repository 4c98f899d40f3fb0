"""Core and output layers: appended inventory -> resolved inventory -> upload."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stockflow.config import RunContext
from stockflow.operators.quality import enforce_match_rate
from stockflow.operators.standardize import with_audit
from stockflow.plans.supply import crosswalk_join, publish_rate, split_resolved, upload_rows
from stockflow.session import materialized
from stockflow.sources.operations import RunResult, logged_run
from stockflow.sources.tables import (
    commit_run,
    ensure_schemas,
    new_folder,
    verify_write,
    write_upload,
)


@dataclass(frozen=True)
class PublishConfig:
    """Settings of the upload; the open questions of the process are parameters here."""

    name: str = "inventory_upload"
    core_table: str = "core.cust_inventory"
    quarantine_table: str = "core.cust_inventory_rejects"
    out_table: str = "out.inventory_upload"
    match_threshold: float = 0.8
    min_rows: int = 1
    quantity: str = "ordered"
    fifth: tuple[str, object] | None = None
    table_format: str = "parquet"
    # Upload files: None keeps the frame's partitions, 1 asks for a single file (one task writes it).
    files: int | None = None
    max_records: int | None = None


def publish_upload(
    spark: SparkSession,
    cfg: PublishConfig,
    inventory: DataFrame,
    xwalk: DataFrame,
    path: str,
    transit: DataFrame | None = None,
    ctx: RunContext | None = None,
    replace: bool = False,
) -> RunResult:
    """Resolve product codes, store core rows and quarantine, gate, then write the upload.

    ``xwalk`` is the crosswalk of ``crosswalk`` or a stored version of it. Its join
    runs once and is stored. Core and quarantine are kept even when too few rows
    can be published, since they show what is missing; the upload is written only
    after the gate, which counts publishable rows. Repeated under its run id, a
    run replaces its own rows, and with ``replace`` its own upload folder.
    """
    ctx = ctx or RunContext.start(path)
    ensure_schemas(spark)
    result = RunResult(
        ctx, "output", cfg.name, core_table=cfg.core_table, out_table=cfg.out_table,
        table_format=cfg.table_format,
    )

    def commit(df: DataFrame, table: str) -> None:
        commit_run(spark, with_audit(df, ctx), table, ctx, cfg.table_format)

    with logged_run(spark, result):
        if not replace:
            new_folder(spark, path)
        with materialized(crosswalk_join(inventory, xwalk), "resolved") as joined:
            matched, unmatched = split_resolved(joined)
            commit(joined, cfg.core_table)
            result.rows_core = verify_write(spark, cfg.core_table, ctx, joined.count())
            commit(unmatched, cfg.quarantine_table)
            enforce_match_rate(publish_rate(joined, cfg.match_threshold, cfg.min_rows))
            with materialized(
                upload_rows(matched, transit, cfg.quantity, cfg.fifth), "upload"
            ) as upload:
                commit(upload, cfg.out_table)
                result.rows_out = verify_write(spark, cfg.out_table, ctx, upload.count())
                write_upload(upload, path, cfg.files, cfg.max_records, replace)
    return result
