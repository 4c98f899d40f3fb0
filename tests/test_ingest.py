"""One source end to end, on success and on every kind of failure."""

from __future__ import annotations

import itertools
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

from stockflow.config import PLATFORM_ZONE, RunContext, SourceConfig
from stockflow.operators.keyed import latest_snapshot
from stockflow.operators.quality import DataQualityError
from stockflow.plans import supply
from stockflow.plans.ingest import ingest
from stockflow.plans.publish import PublishConfig, publish_upload
from stockflow.session import shared_folder
from stockflow.sources.files import StaleSourceError
from stockflow.sources.operations import (
    REGISTRY,
    RUN_LOG,
    failed_runs,
    registry_current,
)
from stockflow.sources.tables import WriteMismatchError, verify_write, write_upload

from .helpers import bag, one

FILE = (
    "Location,Item,MaxOrderQty,OnHand Qty,Total In-Transit Qty\n"
    'A ,00123,10,1.2,"1,234"\n'
    "A,00123,10, 7 ,\n"
    "location,item,maxorderqty,onhand_qty,total_in_transit_qty\n"
    "B,\xa000124\t,NA,12d,3\n"
    "Location,Item,1,1,1\n"
    "C,9,,inf,4\n"
)
_names = (f"acme{i}" for i in itertools.count())


@pytest.fixture
def cfg(tmp_path):
    path = tmp_path / "stock.csv"
    path.write_text(FILE)
    return SourceConfig(
        next(_names), "cust_inventory", str(path),
        expected_columns=("location", "item", "maxorderqty", "onhand_qty", "total_in_transit_qty"),
        required_columns=("location", "item", "onhand_qty"),
        business_key=("location", "item"),
        renames={"maxorderqty": "max_order_qty", "onhand_qty": "on_hand_qty", "total_in_transit_qty": "in_transit_qty"},
        quantity_columns=("on_hand_qty", "in_transit_qty", "max_order_qty"),
        text_columns=("location", "item"),
        header_key="location",
        header_literals=("location", "Location"),
        owner="team",
    )


def logged(spark, cfg):
    return spark.table(RUN_LOG).where(f"source_name = '{cfg.source_name}'")


def leftovers(spark):
    root = Path(shared_folder(spark)) / "stockflow"
    return [p for p in root.rglob("*.parquet")] if root.exists() else []


def test_success(spark, cfg):
    ctx = RunContext.start(cfg.src_path)
    result = ingest(spark, cfg, ctx)
    assert (result.rows_raw, result.rows_stg) == (6, 3)
    assert cfg.raw_table == f"sbx.cust_inventory_{cfg.source_name}_raw"

    raw = spark.table(cfg.raw_table)
    assert {"load_date", "load_timestamp", "src_file_name", "pipeline_run_id"} < set(raw.columns)
    assert not [c for c in raw.columns if c.startswith("_")]
    assert bag(raw, "location", "onhand_qty")[("A ", "1.2")] == 1  # unmodified

    stg = spark.table(cfg.stg_table)
    assert bag(stg, "location", "item", "max_order_qty", "on_hand_qty", "in_transit_qty") == {
        ("A", "00123", 10, 7, 0): 1, ("B", "00124", 0, 0, 3): 1, ("C", "9", 0, 0, 4): 1,
    }
    assert dict(stg.dtypes)["on_hand_qty"] == "bigint" and dict(stg.dtypes)["load_date"] == "date"
    assert bag(spark.table(cfg.rejects_table), "location", "on_hand_qty", "reason") == {
        ("A", 2, "DUPLICATE_KEY"): 1, ("location", 0, "EMBEDDED_HEADER"): 1, ("Location", 1, "EMBEDDED_HEADER"): 1,
    }
    row = one(logged(spark, cfg))
    assert (row.status, row.rows_raw, row.rows_stg, row.rows_core, row.message) == ("SUCCESS", 6, 3, 0, "")
    assert (row.raw_table, row.stg_table, row.core_table) == (cfg.raw_table, cfg.stg_table, None)
    assert row.executed_by and row.pipeline_run_id == ctx.run_id
    assert not leftovers(spark)


def test_gates_are_taken_in_the_pass_that_writes(spark, cfg, monkeypatch):
    """The stored copy is not read for the gates, but for the keys of the staged layer."""
    from stockflow.plans import ingest as module

    asked = []
    real = module.dq_metrics
    monkeypatch.setattr(module, "dq_metrics", lambda df, **checks: asked.append(sorted(checks)) or real(df, **checks))
    ingest(spark, cfg)
    assert asked == [["unique_key"]]
    # Values seen while writing are those of an aggregate over the rows.
    rows = spark.createDataFrame([("A", "1", "x", None), (None, "2", "3", "more")], "location string, item string, onhand_qty string, _src_overflow string")
    gate = module.raw_gate(rows.columns, cfg)
    with module.observed(rows, "seen", gate.values) as (copy, seen):
        assert bag(gate.of(spark, seen)) == bag(module.raw_metrics(copy, cfg)) and copy.count() == 2
    with module.observed(rows, "seen", {}) as (copy, seen):
        assert seen == {} and copy.count() == 2
    assert not leftovers(spark)


def test_runs_append_and_the_latest_is_read(spark, cfg):
    day = datetime(2030, 1, 2, 9, tzinfo=PLATFORM_ZONE)
    fresh = replace(cfg, warn_hours=None, fail_hours=None)
    for i, hour in enumerate((9, 11, 10)):
        Path(cfg.src_path).write_text(FILE + f"D,{i},1,1,1\n")
        ingest(spark, fresh, RunContext(f"{cfg.source_name}-{i}", day.replace(hour=hour), cfg.src_path))
    stg = spark.table(cfg.stg_table)
    assert stg.count() == 12
    assert bag(latest_snapshot(stg).where("location = 'D'"), "item") == {("1",): 1}

    current = one(registry_current(spark.table(REGISTRY).where(f"source_name = '{cfg.source_name}'")))
    assert current.last_run_id == f"{cfg.source_name}-1" and current.last_stg_row_count == 4
    assert current.first_loaded.hour == day.replace(hour=9).astimezone(tz=None).hour
    assert current.expected_columns.startswith('["location", "item"')


@pytest.mark.parametrize(
    "change, text, error, rows_raw",
    [
        ({"min_rows": 100}, FILE, DataQualityError, 0),
        ({"required_columns": ("warehouse",)}, FILE, DataQualityError, 0),
        ({}, FILE + ",8,1,1,1\n", DataQualityError, 0),
        ({"fail_hours": -1}, FILE, StaleSourceError, 0),
        ({"src_path": "/nonexistent/stock.csv"}, FILE, FileNotFoundError, 0),
        ({"custom": lambda df: df.unionAll(df), "business_key": (), "min_rows": 1}, FILE, None, 6),
        ({"custom": lambda df: df.where("false")}, FILE, DataQualityError, 6),
    ],
    ids=["rows", "columns", "null key", "stale", "missing", "no key", "staged gate"],
)
def test_failures_are_logged_and_raised(spark, cfg, change, text, error, rows_raw):
    Path(cfg.src_path).write_text(text)
    broken = replace(cfg, **change)
    if error is None:
        assert ingest(spark, broken).rows_stg == 8
        return
    with pytest.raises(error):
        ingest(spark, broken)
    row = one(logged(spark, cfg))
    assert (row.status, row.rows_raw, row.rows_stg) == ("FAILURE", rows_raw, 0)
    assert error.__name__ in row.message
    assert spark.catalog.tableExists(cfg.raw_table) == bool(rows_raw)
    assert not spark.catalog.tableExists(cfg.stg_table)
    assert one(failed_runs(logged(spark, cfg), row.load_date)).pipeline_run_id == row.pipeline_run_id
    assert failed_runs(logged(spark, cfg), date(2000, 1, 1)).isEmpty()
    assert not leftovers(spark)


def test_a_column_changed_at_the_source_fails_the_append(spark, cfg):
    ingest(spark, cfg)
    lines = FILE.replace("Location,Item", "Location,Shelf,Item", 1).splitlines()
    Path(cfg.src_path).write_text("\n".join([lines[0], "A,s,00123,1,1,1"]))
    with pytest.raises(Exception):
        ingest(spark, cfg)
    assert {r.status for r in logged(spark, cfg).collect()} == {"SUCCESS", "FAILURE"}


def test_production_tables(cfg):
    prod = replace(cfg, env="prod")
    assert prod.raw_table == f"raw.cust_inventory_{cfg.source_name}"
    assert prod.stg_table == f"stg.cust_inventory_{cfg.source_name}"
    with pytest.raises(ValueError):
        replace(cfg, env="test")


def test_verify_write(spark, cfg):
    ctx = RunContext.start(cfg.src_path)
    ingest(spark, cfg, ctx)
    assert verify_write(spark, cfg.raw_table, ctx, 6) == 6
    with pytest.raises(WriteMismatchError):
        verify_write(spark, cfg.raw_table, ctx, 7)
    later = RunContext(ctx.run_id, ctx.load_timestamp + timedelta(days=1))
    assert verify_write(spark, cfg.raw_table, later, 0) == 0


def test_upload_file(spark, tmp_path):
    df = spark.createDataFrame([(f"P{i}", "1 001", i, 0.0) for i in range(10)], "Product string, `CompanyCode-Ship` string, `On Hand` long, `In Transit` double")
    write_upload(df, str(tmp_path / "one"))
    files = list((tmp_path / "one").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "Product,CompanyCode-Ship,On Hand,In Transit"
    write_upload(df, str(tmp_path / "many"), max_records=4)
    assert len(list((tmp_path / "many").glob("*.csv"))) == 3


BUYLIST = "Company string, BuyListCode string, ItemCode string, StateReferenceNumber string, BuylistItemStatus string, CustomerCrossReference string, Customer string, CustomerDeliveryAddressCode string, CustomerFullName string, BuyListDetailKey string"


def test_publish(spark, tmp_path):
    buylist = spark.createDataFrame([("SA", "L", "P1", "i1", "1", "x", "c", "001", "f", "k")], BUYLIST)
    inventory = spark.createDataFrame([("s", "c 001", "i1", 5, None), ("s", "c 001", "i2", 6, None)], "source string, location string, item string, on_hand_qty long, in_transit_qty long")
    names = {"core_table": "core.t1", "quarantine_table": "core.t1_rejects", "out_table": "out.t1"}
    with pytest.raises(DataQualityError):
        publish_upload(spark, PublishConfig("u1", **names), inventory, supply.crosswalk(buylist), str(tmp_path / "a"))
    assert spark.table("core.t1").count() == 2 and spark.table("core.t1_rejects").count() == 1
    assert not spark.catalog.tableExists("out.t1") and not (tmp_path / "a").exists()

    ok = PublishConfig("u1", match_threshold=0.5, **names)
    result = publish_upload(spark, ok, inventory, supply.crosswalk(buylist), str(tmp_path / "a"))
    assert (result.rows_core, result.rows_out) == (2, 1)
    assert bag(spark.table("out.t1"), "Product", "CompanyCode-Ship", "On Hand", "In Transit") == {("P1", "c 001", 5, 0.0): 1}
    assert bag(spark.read.csv(str(tmp_path / "a"), header=True)) == {("P1", "c 001", "5", "0.0"): 1}
    runs = spark.table(RUN_LOG).where("source_name = 'u1'")
    assert bag(runs, "status", "rows_core", "rows_out", "raw_table", "core_table") == {
        ("FAILURE", 2, 0, None, "core.t1"): 1, ("SUCCESS", 2, 1, None, "core.t1"): 1,
    }
    assert not leftovers(spark)


def test_publish_keeps_partitions_of_the_upload(spark, tmp_path, monkeypatch):
    """The upload does not pass one task unless a single file is asked for."""
    from stockflow.plans import publish

    asked = []
    monkeypatch.setattr(publish, "write_upload", lambda df, path, files=1, max_records=None, replace=False: asked.append((files, max_records)))
    buylist = spark.createDataFrame([("SA", "L", "P1", "i1", "1", "x", "c", "001", "f", "k")], BUYLIST)
    inventory = spark.createDataFrame([("s", "c 001", "i1", 5, None)], "source string, location string, item string, on_hand_qty long, in_transit_qty long")
    names = {"core_table": "core.t2", "quarantine_table": "core.t2_rejects", "out_table": "out.t2"}
    publish_upload(spark, PublishConfig("u2", **names), inventory, supply.crosswalk(buylist), str(tmp_path / "a"))
    publish_upload(spark, PublishConfig("u2", files=1, max_records=9, **names), inventory, supply.crosswalk(buylist), str(tmp_path / "b"))
    assert asked == [(None, None), (1, 9)]
