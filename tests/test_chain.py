"""From files to upload in one call, its reruns, and versions of what is shared."""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockflow.config import PLATFORM_ZONE, RunContext, SourceConfig
from stockflow.operators.quality import DataQualityError
from stockflow.operators.standardize import with_audit
from stockflow.plans import chain, supply
from stockflow.plans.chain import ChainConfig, domain_as_of, run_chain, staged_inventory
from stockflow.plans.publish import PublishConfig
from stockflow.sources.operations import RUN_LOG, snapshot, winning_runs
from stockflow.sources.tables import SchemaMismatchError, commit_run, ensure_schemas

from .helpers import bag
from .test_ingest import BUYLIST

DAY = datetime(2031, 3, 4, 9, tzinfo=PLATFORM_ZONE)
ENTRIES = [("SA", "L", "P1", "i1", "1", "x", "c", "001", "f", "k"), ("SA", "L", "P2", "i2", "1", "y", "c", "001", "f", "k")]


def source(tmp_path, name, text):
    path = tmp_path / f"{name}.csv"
    path.write_text(text)
    return SourceConfig(
        name, "cust_inventory", str(path), required_columns=("location", "item", "on_hand_qty"),
        business_key=("location", "item"), text_columns=("location", "item"), quantity_columns=("on_hand_qty",),
        warn_hours=None, fail_hours=None,
    )


@pytest.fixture
def setting(spark, tmp_path, request):
    tag = request.node.name.replace("[", "_").replace("]", "")[:40]
    a = source(tmp_path, f"{tag}_a", "location,item,on_hand_qty\nc 001,i1,5\nc 001,i1,6\nc 001,i9,1\n")
    b = source(tmp_path, f"{tag}_b", "item,on_hand_qty,location\ni2,7,c 001\ni1,2,c 001\n")
    publish = PublishConfig(tag, f"core.{tag}", f"core.{tag}_rejects", f"out.{tag}", match_threshold=0.5)
    cfg = ChainConfig(
        (a, b), publish, crosswalk_table=f"core.{tag}_xwalk", transit_table=f"core.{tag}_transit",
    )
    lists = lambda: spark.createDataFrame(ENTRIES, BUYLIST)
    return cfg, lists, str(tmp_path / "out")


def tables_of(spark, cfg):
    names = [t for s in cfg.sources for t in (s.raw_table, s.stg_table, s.rejects_table)]
    names += [cfg.publish.core_table, cfg.publish.quarantine_table, cfg.publish.out_table, cfg.crosswalk_table]
    return {n: bag(spark.table(n)) for n in names}


def upload(spark, path):
    return bag(spark.read.csv(path, header=True))


def test_files_to_upload_and_the_same_again(spark, setting):
    cfg, lists, root = setting
    ctx = RunContext("day-1", DAY)
    result = run_chain(spark, cfg, root, ctx, buylist=lists)
    want = {("P1", "c 001", "6", "0.0"): 1, ("P2", "c 001", "7", "0.0"): 1, ("P1", "c 001", "2", "0.0"): 1}
    assert upload(spark, result.path) == want and result.path.endswith("load_date=2031-03-04/run=day-1")
    assert {n: (r.rows_raw, r.rows_stg) for n, r in result.sources.items()} == {cfg.sources[0].source_name: (3, 2), cfg.sources[1].source_name: (2, 2)}
    assert (result.crosswalk.rows_core, result.upload.rows_core, result.upload.rows_out) == (2, 4, 3)
    assert bag(spark.table(cfg.publish.quarantine_table), "item", "reason") == {("i9", "NO_SKU_MATCH"): 1}

    before = tables_of(spark, cfg)
    again = run_chain(spark, cfg, root, ctx, buylist=lists)
    assert tables_of(spark, cfg) == before and upload(spark, again.path) == want
    # Repeated a day later under its id, a run leaves nothing under the first date.
    later = run_chain(spark, cfg, root, RunContext("day-1", DAY + timedelta(days=1)), buylist=lists)
    stg = spark.table(cfg.sources[0].stg_table)
    assert stg.count() == 2 and {str(r.load_date) for r in stg.collect()} == {"2031-03-05"}
    assert upload(spark, later.path) == want


def test_the_crosswalk_is_built_once(spark, setting, monkeypatch):
    cfg, lists, root = setting
    built = []
    real = supply.crosswalk
    monkeypatch.setattr(supply, "crosswalk", lambda *a, **k: built.append(1) or real(*a, **k))
    day = [("c 001", "o1", 3.0, 1.0, "P1", None, "x", "x", "Oracle", "c 001x", "In Transit")]
    monkeypatch.setattr(supply, "in_transit", lambda orders, xwalk, asof, days: orders)
    columns = "CUSTOMER string, ORDN55 string, CASES_ORD double, CASES_STP double, CATN55 string, CSRQ40 date, CSRF32 string, SIRF32 string, `Data Source` string, Key string, `PO Status 2` string"
    result = run_chain(
        spark, replace(cfg, transit_days=3), root, RunContext("t-1", DAY), buylist=lists,
        orders=lambda: spark.createDataFrame(day, columns),
    )
    assert built == [1] and result.transit.rows_core == 1
    assert upload(spark, result.path)[("P1", "c 001", "6", "3.0")] == 1


def test_domains_are_read_as_of_a_run(spark, setting):
    cfg, _, root = setting
    first, second = (lambda k=k: spark.createDataFrame(ENTRIES[:k], BUYLIST) for k in (1, 2))
    with pytest.raises(DataQualityError, match="match rate 0.5 .*NO_SKU_MATCH=2"):
        run_chain(spark, replace(cfg, publish=replace(cfg.publish, match_threshold=0.8)), root, RunContext("v-1", DAY), buylist=first)
    run_chain(spark, cfg, root, RunContext("v-2", DAY + timedelta(hours=2)), buylist=second)
    as_of = lambda hours: bag(domain_as_of(spark, cfg.crosswalk_table, DAY + timedelta(hours=hours)), "CATN32")
    assert as_of(1) == {("P1",): 1} and as_of(3) == {("P1",): 1, ("P2",): 1} and as_of(-1) == {}
    # A version that fails its gate is never read.
    with pytest.raises(DataQualityError):
        run_chain(spark, cfg, root, RunContext("v-3", DAY + timedelta(hours=4)), buylist=lambda: first().limit(0))
    assert as_of(9) == {("P1",): 1, ("P2",): 1}


def test_a_source_that_fails(spark, setting, tmp_path):
    cfg, lists, root = setting
    run_chain(spark, cfg, root, RunContext("f-1", DAY), buylist=lists)
    (tmp_path / f"{cfg.sources[1].source_name}.csv").write_text("item,shelf\ni2,1\n")
    with pytest.raises(DataQualityError):
        run_chain(spark, cfg, root, RunContext("f-2", DAY + timedelta(hours=1)), buylist=lists)
    kept = run_chain(spark, replace(cfg, keep_previous=True), root, RunContext("f-3", DAY + timedelta(hours=2)), buylist=lists)
    assert list(kept.failed) == [cfg.sources[1].source_name] and kept.upload.rows_out == 3
    unknown = replace(cfg.sources[0], source_name="never_loaded")
    with pytest.raises(ValueError, match="never_loaded has no staged rows"):
        staged_inventory(spark, (unknown,), DAY)


def test_commit_replaces_its_run_only(spark):
    ensure_schemas(spark)
    one, two = RunContext("it's", DAY), RunContext("other", DAY)
    rows = lambda ctx, *v: with_audit(spark.createDataFrame([(x, x * 2) for x in v], "a long, b long"), ctx)
    for ctx, values in ((one, (1, 2)), (two, (3,)), (one, (4,))):
        commit_run(spark, rows(ctx, *values), "core.commits", ctx)
    assert bag(spark.table("core.commits"), "a", "pipeline_run_id") == {(4, "it's"): 1, (3, "other"): 1}
    commit_run(spark, rows(one).select("b", "a", "load_date", "load_timestamp", "src_file_name", "pipeline_run_id"), "core.commits", one)
    assert bag(spark.table("core.commits"), "a") == {(3,): 1}
    with pytest.raises(SchemaMismatchError):
        commit_run(spark, rows(one, 1).withColumn("a", F.lit("x")), "core.commits", one)
    with pytest.raises(SchemaMismatchError):
        commit_run(spark, rows(one, 1).drop("b"), "core.commits", one)
    assert bag(spark.table("core.commits"), "a") == {(3,): 1}


def test_snapshot_prunes_partitions_and_finds_late_corrections(spark):
    ensure_schemas(spark)
    runs = []
    for run, days, hour, value in (("a", 0, 9, 1), ("b", 1, 9, 2), ("late", 0, 11, 3), ("earlier", 0, 10, 4), ("failed", 1, 12, 5)):
        ctx = RunContext(run, DAY.replace(hour=hour) + timedelta(days=days))
        commit_run(spark, with_audit(spark.createDataFrame([(value,)], "v long"), ctx), "core.snapshots", ctx)
        runs.append((ctx.load_date, ctx.load_timestamp, run, "core.snapshots", "FAILURE" if run == "failed" else "SUCCESS"))
    log = spark.createDataFrame(runs, "load_date date, load_timestamp timestamp, pipeline_run_id string, stg_table string, status string")
    log.write.mode("overwrite").saveAsTable("core.snapshot_log")
    log = spark.table("core.snapshot_log")
    daily = snapshot(spark.table("core.snapshots"), winning_runs(log, "core.snapshots", keys=("load_date",)))
    assert bag(daily, "v", "pipeline_run_id") == {(3, "late"): 1, (2, "b"): 1}
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    newest = snapshot(spark.table("core.snapshots"), winning_runs(log, "core.snapshots"))
    assert bag(newest, "v") == {(2,): 1}
    past = winning_runs(log, "core.snapshots", asof=DAY.replace(hour=10, minute=30))
    assert bag(snapshot(spark.table("core.snapshots"), past), "v") == {(4,): 1}
    assert snapshot(spark.table("core.snapshots"), winning_runs(log, "core.none")).isEmpty()


def test_chain_reads_the_erp_of_a_schema(spark, setting, sf_dir):
    """By default both ERP frames come from catalog tables."""
    from verification import shapes

    cfg, _, root = setting
    spark.sql("CREATE SCHEMA IF NOT EXISTS erp_chain")
    from stockflow.plans import erp

    for tables, shaped in ((erp.BUYLIST_TABLES, shapes.buylist_tables(spark, sf_dir)), (erp.ORDER_TABLES, shapes.order_tables(spark, sf_dir))):
        for role, name in tables.items():
            shaped[role].write.mode("overwrite").saveAsTable(f"erp_chain.{name}")
    first, last = datetime(1997, 1, 5, 9, tzinfo=PLATFORM_ZONE), datetime(1998, 1, 5, 9, tzinfo=PLATFORM_ZONE)
    days = (last - first).days
    with ExitStack() as stack:
        found = chain.requested_orders(spark, replace(cfg, schema="erp_chain", transit_days=days), RunContext("e", last), stack)
        whole = erp.orders_base(erp.catalog_tables(spark, erp.ORDER_TABLES, "erp_chain"))
        want = supply.shippable_lines(whole, last.date(), days).select(*erp.TRANSIT_COLUMNS).distinct()
        got = supply.shippable_lines(found, last.date(), days)
        assert got.count() > 0 and bag(got) == bag(want)
