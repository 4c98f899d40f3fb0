"""Every registered query against its SQL check, and the shape of its plan."""

from __future__ import annotations

import re
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry_module
from verification import queries as queries_module
from verification.compare import connect, difference
from verification.oracle import ORACLE
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    assert not difference(df, con, ORACLE[name])


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLE.keys() <= entry_module.oracle_sql().keys()


def test_entry(spark):
    assert entry_module.entry(spark).columns[0] == "PONumber"


def explained(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_date_window_reaches_the_scan(spark, sf_dir):
    text = explained(spark, QUERIES["in_transit"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate,1997-12-06T00:00), LessThanOrEqual(l_shipdate,1998-01-05T00:00)" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = explained(spark, QUERIES["crosswalk_keys"](spark, sf_dir))
    part = [s for s in re.findall(r"ReadSchema: (.*)", text) if "p_partkey" in s]
    assert part == ["struct<p_partkey:bigint>"]


@pytest.mark.parametrize("name", ["latest_fulfill_line", "dedupe_keep_last", "ranked_crosswalk"])
def test_one_row_per_key_is_limited_before_the_shuffle(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    window, rest = text.split("Exchange hashpartitioning", 1) if name != "ranked_crosswalk" else text.split("WindowGroupLimit", 1)
    assert re.search(r"row_number\(\), 1, Partial", rest)


def test_snapshot_does_not_shuffle_the_table(spark, sf_dir):
    df = QUERIES["latest_snapshot"](spark, sf_dir)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text.split("== Initial Plan ==")[0]


def test_reconcile_is_one_aggregate_of_counts(spark, sf_dir):
    text = QUERIES["reconcile_tables"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "partial_sum" in text


def test_join_buckets_do_not_widen_the_scan(spark, sf_dir):
    """Of the 28 item-master columns the crosswalk needs none but the key."""
    text = explained(spark, QUERIES["ranked_crosswalk"](spark, sf_dir))
    assert "p_name" not in text and "p_retailprice" not in text and "l_shipdate" not in text


def session_like(spark, master, **settings):
    """What the choice of a folder sees of a session with these settings alone."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, defaultParallelism=2)
    return SimpleNamespace(conf=settings, sparkContext=context, range=spark.range, read=spark.read)


@pytest.mark.parametrize("master", ["local[2]", "local-cluster[3,4,1024]", "spark://elsewhere:7077"])
def test_a_folder_is_found_without_checkpoint_setting(spark, tmp_path, master):
    near = {"spark.sql.warehouse.dir": f"file:{tmp_path}/warehouse"}
    found = queries_module._new_folder(session_like(spark, master, **near))
    assert found.startswith("file:///" if master == "local[2]" else f"file:{tmp_path}/warehouse/stockflow/")
    mounted = near | {"spark.checkpoint.dir": f"file://{tmp_path}/mount"}
    assert queries_module._new_folder(session_like(spark, master, **mounted)).startswith(f"file://{tmp_path}/mount/stockflow/")


def test_no_folder_where_none_can_be_written(spark, tmp_path):
    (tmp_path / "file").write_text("not a folder")
    near = {"spark.sql.warehouse.dir": f"file:{tmp_path}/file", "spark.checkpoint.dir": f"file:{tmp_path}/file/in"}
    assert queries_module._new_folder(session_like(spark, "spark://elsewhere:7077", **near)) is None


@pytest.mark.parametrize("name", ["near_miss_keys", "snapshot_from_log", "upload_rows_in_transit"])
def test_equals_sql_without_shared_folder(spark, sf_dir, con, name, monkeypatch):
    monkeypatch.setattr(queries_module, "_new_folder", lambda spark: None)
    assert not difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])


def test_upload_stores_orders_in_transit_before_it_is_planned(spark, sf_dir, tmp_path, monkeypatch):
    looked = []
    monkeypatch.setattr(queries_module, "_new_folder", lambda spark: looked.append(1) or f"file:{tmp_path}/stored")
    df = QUERIES["upload_rows_in_transit"](spark, sf_dir)
    assert len(looked) == 1
    # Crosswalk, qualifying lines, keys of their fulfil lines, orders in transit.
    assert len(list((tmp_path / "stored").iterdir())) == 4
    # The date window of the orders is no part of the upload's own plan.
    assert "1997-12-06" not in explained(spark, df)
