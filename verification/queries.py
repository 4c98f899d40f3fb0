"""Every operator run over the given tables, by query name."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.config import RunContext, SourceConfig
from stockflow.functions import text
from stockflow.operators.distributor import (
    SheetConfig,
    append_sources,
    normalize_distributor,
    sheet_inventory,
    sheet_rows,
    unmapped,
)
from stockflow.operators.joins import JoinSide, fanout_metrics, reconcile, reconcile_changes
from stockflow.operators.keyed import dedupe_last, latest_snapshot
from stockflow.operators.quality import dq_metrics, match_rate, near_miss
from stockflow.operators.standardize import split_embedded_headers, standardize, with_audit
from stockflow.plans import audit, erp, supply, transition
from stockflow.plans.ingest import raw_metrics
from stockflow.session import PLACED_JOINS, session_with
from stockflow.sources.operations import (
    failed_runs,
    registry_current,
    run_log_rules,
    snapshot,
    winning_runs,
)
from stockflow.sources.sheets import detect_headers, mapped_rows
from verification import shapes
from verification.shapes import shaped

Query = Callable[[SparkSession, str], DataFrame]

log = logging.getLogger(__name__)

ASOF = date(1998, 1, 5)
WINDOW_DAYS = 30
RUN = RunContext("run-0001", datetime(2026, 5, 18, 14, 30, tzinfo=timezone.utc), "orders.parquet")

FILE = SourceConfig(
    source_name="events",
    domain="cust_inventory",
    src_path="events",
    expected_columns=("location", "item", "maxorderqty", "onhand_qty", "pack_size"),
    required_columns=("location", "item", "onhand_qty"),
    business_key=("location", "item"),
    renames={
        "maxorderqty": "max_order_qty",
        "onhand_qty": "on_hand_qty",
        "total_in_transit_qty": "in_transit_qty",
    },
    text_columns=("location", "item"),
    quantity_columns=("on_hand_qty", "in_transit_qty", "max_order_qty"),
    header_key="location",
    header_literals=("location", "Location"),
    min_rows=1000,
    max_rows=5000,
)
FILE_ORDER = ("ts", "event_id")
SHEET = SheetConfig(location="report_title", item="column4", on_hand="column11")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _buylist(spark, sf_dir, whole=False, columns=()) -> DataFrame:
    return erp.buylist_detail(shapes.buylist_tables(spark, sf_dir), whole, columns)


def _orders(spark, sf_dir, whole=False) -> DataFrame:
    spark = session_with(spark, PLACED_JOINS) if whole else spark
    return erp.orders_base(shapes.order_tables(spark, sf_dir), whole)


def _inventory(spark, sf_dir) -> DataFrame:
    return shaped(spark, sf_dir, shapes.INVENTORY)


def _crosswalk(spark, sf_dir) -> DataFrame:
    return supply.crosswalk(_buylist(spark, sf_dir, columns=supply.CROSSWALK_INPUT))


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared folder, for queries that read it more than once.

    Where there is no such folder it stays as it is and is computed at each reading.
    """
    return _store(df.sparkSession)(df)


def _store(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """``_stored`` for several frames, with one look for the folder."""
    folder = _new_folder(spark)

    def stored(df: DataFrame) -> DataFrame:
        if folder is None:
            return df
        path = f"{folder}/{uuid.uuid4()}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return stored


def _new_folder(spark: SparkSession) -> str | None:
    """A new folder that driver and executors reach: below the checkpoint folder, else below
    the warehouse. None where neither is, as with folders of one machine of a cluster."""
    checkpoints = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not checkpoints and spark.sparkContext.master.startswith("local["):
        checkpoints = f"file://{tempfile.mkdtemp(prefix='shared-')}"
    for folder in (checkpoints, spark.conf.get("spark.sql.warehouse.dir", None)):
        if folder and _reached(spark, folder):
            return f"{folder.rstrip('/')}/stockflow/{uuid.uuid4()}"
    return None


def _reached(spark: SparkSession, folder: str) -> bool:
    """Whether a small table that all tasks write below ``folder`` is there for the driver."""
    path, n = f"{folder.rstrip('/')}/stockflow/{uuid.uuid4()}", spark.sparkContext.defaultParallelism
    try:
        spark.range(0, n, 1, n).write.parquet(path)
        return spark.read.schema("id long").parquet(path).count() == n
    except Exception:
        log.warning("%s cannot be used to share tables", folder, exc_info=True)
        return False


def sanitize_identifier(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    label = F.concat(F.lit(" "), "p_brand", F.lit("  "), "p_type", F.lit("#"))
    return part.select("p_partkey", text.sanitize_col(label).alias("identifier"))


def concat_rules(spark, sf_dir):
    buylist = shaped(spark, sf_dir, shapes.BUYLIST["list_customer"])
    parts = [F.col("CUSTOMER"), F.col("DELIVERY_ADDRESS_CODE")]
    return buylist.select(
        "BUYLISTKEY",
        text.sql_concat(parts[0], F.lit(" "), parts[1]).alias("by_sql"),
        text.text_combine(" ", *parts).alias("by_combine"),
        text.amp_concat(*parts).alias("by_amp"),
    )


def delivery_segment(spark, sf_dir):
    sites = shaped(spark, sf_dir, shapes.ORDERS["party_site"])
    return sites.select(
        "PARTYSITEID", text.middle_segment(F.col("PARTYSITENUMBER")).alias("segment")
    )


def stage_standardize(spark, sf_dir):
    raw = shaped(spark, sf_dir, shapes.RAW_FILE)
    return standardize(raw, FILE, order=FILE_ORDER, row_id="event_id").kept


def standardize_rejects(spark, sf_dir):
    raw = shaped(spark, sf_dir, shapes.RAW_FILE)
    return standardize(raw, FILE, order=FILE_ORDER, row_id="event_id").rejected


def drop_embedded_headers(spark, sf_dir):
    raw = shaped(spark, sf_dir, shapes.RAW_FILE).withColumn(
        "location", text.strip_ws(F.col("location"))
    )
    return split_embedded_headers(raw, "location", FILE.header_literals).kept


def _events_by_user(spark, sf_dir):
    return dedupe_last(
        _table(spark, sf_dir, "events"), ("user_id", "event_type"), ("ts", "event_id"), "event_id"
    )


def dedupe_keep_last(spark, sf_dir):
    return _events_by_user(spark, sf_dir).kept


def dedupe_rejects(spark, sf_dir):
    return _events_by_user(spark, sf_dir).rejected


def audit_columns(spark, sf_dir):
    audited = with_audit(_table(spark, sf_dir, "orders"), RUN)
    # As UTC wall time, so that the result does not depend on the session's zone.
    local = F.col("load_timestamp").cast("timestamp_ntz")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    return audited.withColumn("load_timestamp", utc)


def _raw_checks(check: str) -> Query:
    def query(spark, sf_dir):
        raw = shaped(spark, sf_dir, shapes.RAW_FILE).drop("event_id", "ts")
        return raw_metrics(raw, FILE).where(F.col("check_name") == check)

    return query


def dq_row_count(spark, sf_dir):
    return dq_metrics(_table(spark, sf_dir, "lineitem"), min_rows=1000, max_rows=50_000)


def dq_unique_key(spark, sf_dir):
    lines = shaped(spark, sf_dir, shapes.ORDERS["fulfill_line"])
    return dq_metrics(
        lines, unique_key=("FULFILLLINESOURCEORDERNUMBER", "FULFILLLINESOURCELINENUMBER")
    )


def latest_fulfill_line(spark, sf_dir):
    return erp.latest_fulfill_lines(shaped(spark, sf_dir, shapes.ORDERS["fulfill_line"]))


def fulfill_null_keys(spark, sf_dir):
    return erp.fulfill_null_keys(shaped(spark, sf_dir, shapes.ORDERS["fulfill_line"]))


def latest_snapshot_query(spark, sf_dir):
    return latest_snapshot(shaped(spark, sf_dir, shapes.SNAPSHOTS), keys=("source", "load_date"))


def snapshot_from_log(spark, sf_dir):
    """Newest run of each day by the run log, over a table that is partitioned by run."""
    rows = shaped(spark, sf_dir, shapes.RUN_ROWS)
    path, table = _new_folder(spark), rows
    if path is not None:
        rows.repartition("load_date", "pipeline_run_id").write.partitionBy("load_date", "pipeline_run_id").parquet(path)
        table = spark.read.schema(rows.schema).parquet(path)
    runs = _stored(shaped(spark, sf_dir, shapes.RUN_ROWS_LOG))
    return snapshot(table, winning_runs(runs, "stg.events", keys=("load_date",)))


def sheet_detected(spark, sf_dir):
    lines = shaped(spark, sf_dir, shapes.SHEET_LINES)
    wanted, aliases = ("site", "item_no", "on_hand_qty"), {"stock": "on_hand_qty"}
    headers = detect_headers(lines, wanted, wanted, aliases)
    return mapped_rows(lines, headers, wanted, aliases).rows.drop("_src_block")


def open_orders(spark, sf_dir):
    return erp.open_orders(_orders(spark, sf_dir))


def join_fanout_metrics(spark, sf_dir):
    t = shapes.order_tables(spark, sf_dir)
    headers = erp.order_headers(t["header"])
    ship_to = t["address"].where(F.col("ORDERADDRESSUSETYPE") == "SHIP_TO")
    items = t["item"].where(F.col("ITEMTRANSLATIONPEOLANGUAGE") == "US")
    latest = erp.latest_fulfill_lines(t["fulfill_line"])
    allocations = t["allocation"].where(F.col("CONTEXT_CODE") == "Allocation Details")
    return fanout_metrics(
        [
            JoinSide("address", headers, ship_to, [("HEADERID", "ORDERADDRESSHEADERID")]),
            JoinSide("account", headers, t["account"], [("HEADERSOLDTOPARTYID", "PARTYID")]),
            JoinSide(
                "item", t["line"], items,
                [
                    ("LINEINVENTORYITEMID", "ITEMBASEPEOINVENTORYITEMID"),
                    ("LINEINVENTORYORGANIZATIONID", "ITEMBASEPEOINVENTORYORGANIZATIONID"),
                ],
            ),
            JoinSide(
                "fulfill_line", t["line"], latest,
                [
                    ("LINEID", "FULFILLLINELINEID"),
                    ("LINEHEADERID", "FULFILLLINEHEADERID"),
                    ("LINEINVENTORYORGANIZATIONID", "FULFILLLINEINVENTORYORGANIZATIONID"),
                ],
            ),
            JoinSide("allocation", latest, allocations, [("FULFILLLINEID", "FULFILL_LINE_ID")]),
        ]
    )


def ranked_crosswalk(spark, sf_dir):
    return supply.ranked_crosswalk(_buylist(spark, sf_dir))


def crosswalk_keys_by_state_reference(spark, sf_dir):
    return supply.crosswalk(_buylist(spark, sf_dir), rank_by="state_reference")


def crosswalk_rule_difference(spark, sf_dir):
    return supply.rank_rule_difference(_buylist(spark, sf_dir))


def crosswalk_join(spark, sf_dir):
    return supply.crosswalk_join(_inventory(spark, sf_dir), _crosswalk(spark, sf_dir))


def crosswalk_match_rate(spark, sf_dir):
    return match_rate(crosswalk_join(spark, sf_dir), "CATN32")


def _unmatched(spark, sf_dir):
    return supply.resolve_sku(_inventory(spark, sf_dir), _crosswalk(spark, sf_dir)).unmatched


def publish_match_rate(spark, sf_dir):
    return supply.publish_rate(crosswalk_join(spark, sf_dir))


def crosswalk_unmatched(spark, sf_dir):
    return supply.unmatched_report(_unmatched(spark, sf_dir))


def near_miss_keys(spark, sf_dir):
    on = [("location", "BLCD32"), ("item", "StateReferenceNumber")]
    xwalk = _stored(_crosswalk(spark, sf_dir).select("Key3", "CATN32", "CSRF32", "BLCD32", "StateReferenceNumber"))
    missed = supply.resolve_sku(_inventory(spark, sf_dir), xwalk).unmatched
    return near_miss(missed.where("reason = 'NO_SKU_MATCH'"), xwalk, on, "CATN32")


def in_transit(spark, sf_dir, xwalk=None, store=lambda rows: rows):
    first = ASOF - timedelta(days=WINDOW_DAYS)
    orders = erp.orders_requested(shapes.order_tables(spark, sf_dir), first, ASOF, store)
    xwalk = _crosswalk(spark, sf_dir) if xwalk is None else xwalk
    return supply.in_transit(orders, xwalk, ASOF, days=WINDOW_DAYS)


def distributor_normalize(spark, sf_dir):
    return normalize_distributor(shaped(spark, sf_dir, shapes.SHEET), SHEET)


def sheet_rejects(spark, sf_dir):
    return sheet_rows(shaped(spark, sf_dir, shapes.SHEET), SHEET).rejected


def sheet_quarantine(spark, sf_dir):
    rejected = sheet_inventory(shaped(spark, sf_dir, shapes.SHEET), SHEET).rejected
    return supply.quarantine_by_reason(rejected)


def unmapped_locations(spark, sf_dir):
    return unmapped(shaped(spark, sf_dir, shapes.SHEET), SHEET)


def _domain_sources(spark, sf_dir):
    sheet = distributor_normalize(spark, sf_dir)
    return append_sources(
        {
            "file": stage_standardize(spark, sf_dir),
            "reported": _inventory(spark, sf_dir),
            "sheet": sheet.select(
                F.col("Dpl Customer (key)").alias("location"),
                F.col("Customer Item Reference").alias("item"),
                F.ceil("On Hand Loaded").alias("on_hand_qty"),
            ),
        }
    )


def _upload(spark, sf_dir, **options):
    return supply.build_upload(
        _domain_sources(spark, sf_dir), _crosswalk(spark, sf_dir), **options
    )


def upload_rows(spark, sf_dir):
    return _upload(spark, sf_dir).rows


def upload_rows_in_transit(spark, sf_dir):
    """Crosswalk, qualifying lines and orders in transit are stored one after the other, so that no
    job has to plan more than one of them."""
    store = _store(spark)
    xwalk = store(_crosswalk(spark, sf_dir))
    transit = store(in_transit(spark, sf_dir, xwalk, store))
    return supply.build_upload(_domain_sources(spark, sf_dir), xwalk, transit=transit, qty="shipped").rows


def upload_quarantine(spark, sf_dir):
    return _upload(spark, sf_dir).quarantine


def quarantine_by_reason(spark, sf_dir):
    return supply.quarantine_by_reason(upload_quarantine(spark, sf_dir))


def buylist_orders_join(spark, sf_dir):
    return erp.buylist_orders(
        shapes.buylist_tables(spark, sf_dir), shapes.order_tables(spark, sf_dir),
        ["BuyListDetailKey", "BuyListCode", "BuylistItemStatus"],
        ["OrdersBaseKey", "OrderNumber", "LineNumber", "OrderQty"],
        match_blank=True,
    )


def buylist_orders_join_strict(spark, sf_dir):
    return erp.buylist_orders(
        shapes.buylist_tables(spark, sf_dir), shapes.order_tables(spark, sf_dir),
        ["BuyListDetailKey", "BuyListCode"], ["OrderNumber", "LineNumber"],
    )


def transition_gap(spark, sf_dir):
    return transition.transition_gap(_buylist(spark, sf_dir))


def transition_items(spark, sf_dir):
    return transition.transition_items(_buylist(spark, sf_dir))


def transition_open_orders(spark, sf_dir):
    return transition.open_orders_in_transition(shapes.order_tables(spark, sf_dir), _buylist(spark, sf_dir))


def reconcile_tables(spark, sf_dir):
    """Order lines against orders; some orders have no line."""
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    return reconcile(lines, orders, ["order_key"])


def reconcile_view(spark, sf_dir):
    """The buying-list view against the items it should hold."""
    items = shaped(spark, sf_dir, shapes.BUYLIST["item"])
    keys = ["Company", "BuyListCode", "ItemCode"]
    base = items.select(
        F.col("COMPANY_CODE").alias("Company"),
        F.col("BUYING_LIST_CODE").alias("BuyListCode"),
        F.col("ITEM_CODE").alias("ItemCode"),
    )
    return reconcile(_buylist(spark, sf_dir), base, keys)


def reconcile_changed_orders(spark, sf_dir):
    before, after = (shaped(spark, sf_dir, s) for s in (shapes.ORDERS_BEFORE, shapes.ORDERS_AFTER))
    return reconcile_changes(before, after, ["o_orderkey"])


def run_log(spark, sf_dir):
    return run_log_rules(shaped(spark, sf_dir, shapes.RUNS))


def run_log_failures(spark, sf_dir):
    return failed_runs(run_log(spark, sf_dir), date(2024, 1, 15))


def registry_current_query(spark, sf_dir):
    return registry_current(shaped(spark, sf_dir, shapes.HISTORY))


def _register(spark, sf_dir):
    return shaped(spark, sf_dir, shapes.REGISTER)


QUERIES: dict[str, Query] = {
    "sanitize_identifier": sanitize_identifier,
    "concat_rules": concat_rules,
    "delivery_segment": delivery_segment,
    "stage_standardize": stage_standardize,
    "standardize_rejects": standardize_rejects,
    "drop_embedded_headers": drop_embedded_headers,
    "dedupe_keep_last": dedupe_keep_last,
    "dedupe_rejects": dedupe_rejects,
    "audit_columns": audit_columns,
    "dq_columns": _raw_checks("columns"),
    "dq_row_count": dq_row_count,
    "dq_nulls": _raw_checks("nulls"),
    "dq_unique_key": dq_unique_key,
    "dq_coercions": _raw_checks("lost_quantity"),
    "latest_fulfill_line": latest_fulfill_line,
    "fulfill_null_keys": fulfill_null_keys,
    "latest_snapshot": latest_snapshot_query,
    "snapshot_from_log": snapshot_from_log,
    "sheet_detected": sheet_detected,
    "buylist_detail_view": lambda spark, sf_dir: _buylist(spark, sf_dir, whole=True),
    "orders_base_view": lambda spark, sf_dir: _orders(spark, sf_dir, whole=True),
    "open_orders": open_orders,
    "join_fanout_metrics": join_fanout_metrics,
    "ranked_crosswalk": ranked_crosswalk,
    "crosswalk_keys": _crosswalk,
    "crosswalk_keys_by_state_reference": crosswalk_keys_by_state_reference,
    "crosswalk_rule_difference": crosswalk_rule_difference,
    "crosswalk_join": crosswalk_join,
    "crosswalk_match_rate": crosswalk_match_rate,
    "crosswalk_unmatched": crosswalk_unmatched,
    "publish_match_rate": publish_match_rate,
    "near_miss_keys": near_miss_keys,
    "in_transit": in_transit,
    "distributor_normalize": distributor_normalize,
    "sheet_rejects": sheet_rejects,
    "sheet_quarantine": sheet_quarantine,
    "quarantine_by_reason": quarantine_by_reason,
    "unmapped_locations": unmapped_locations,
    "append_sources": _domain_sources,
    "upload_rows": upload_rows,
    "upload_rows_in_transit": upload_rows_in_transit,
    "upload_quarantine": upload_quarantine,
    "buylist_orders_join": buylist_orders_join,
    "buylist_orders_join_strict": buylist_orders_join_strict,
    "transition_gap": transition_gap,
    "transition_items": transition_items,
    "transition_open_orders": transition_open_orders,
    "reconcile_tables": reconcile_tables,
    "reconcile_view": reconcile_view,
    "reconcile_changes": reconcile_changed_orders,
    "run_log": run_log,
    "run_log_failures": run_log_failures,
    "registry_current": registry_current_query,
    "source_audit": lambda spark, sf_dir: audit.source_audit(_register(spark, sf_dir)),
    "shared_sources": lambda spark, sf_dir: audit.shared_sources(_register(spark, sf_dir)),
    "shared_source_members": lambda spark, sf_dir: audit.shared_source_members(
        _register(spark, sf_dir)
    ),
}
