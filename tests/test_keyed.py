from __future__ import annotations

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockflow.operators.keyed import (
    dedupe_last,
    first_match,
    latest_by,
    latest_snapshot,
    null_key_groups,
)

from .helpers import bag


def test_latest_by_nulls_are_oldest_and_ties_are_settled(spark):
    rows = [("a", 1, 1), ("a", 3, 1), ("a", 3, 2), ("a", None, 9), (None, 5, 1), (None, 4, 1), ("b", None, 1)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    assert bag(latest_by(df, ["k"], "t", ["id"])) == {("a", 3, 2): 1, (None, 5, 1): 1, ("b", None, 1): 1}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2)), min_size=1, max_size=40))
def test_dedupe_last_is_the_last_row_of_the_file(spark, keys):
    rows = [(k, n, i) for i, (k, n) in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, n int, id long").repartition(3)
    kept, rejected = dedupe_last(df, ["k", "n"], ["id"], "id")
    pdf = pd.DataFrame(rows, columns=["k", "n", "id"]).drop_duplicates(["k", "n"], keep="last")
    assert sorted(r.id for r in kept.collect()) == sorted(pdf.id)
    lost = rejected.collect()
    assert sorted([r.id for r in kept.collect()] + [r.id for r in lost]) == list(range(len(rows)))
    assert all(r.reason == "DUPLICATE_KEY" for r in lost)


def test_first_match_never_multiplies(spark):
    left = spark.createDataFrame([("c1", "s1"), ("c1", "s1"), ("c2", "s1"), (None, "s1")], "c string, s string")
    right = spark.createDataFrame(
        [("c1", "s1", "1", "X2"), ("c1", "s1", "0", "X1"), (None, "s1", "0", "X9")],
        "rc string, rs string, status string, ref string",
    )
    got = first_match(left, right, [("c", "rc"), ("s", "rs")], [F.col("status").asc(), F.col("ref").asc()], ["ref"])
    assert bag(got) == {("c1", "s1", "X1"): 2, ("c2", "s1", None): 1, (None, "s1", None): 1}


SNAPSHOT = [
    ("s", 1, "r1", 10, "old"), ("s", 1, "r2", 20, "new"), ("s", 1, "r2", 20, "new too"),
    ("s", 2, "r3", 5, "only"), (None, 1, "r4", 1, "null key"), ("t", 1, "r5", 7, "tie"), ("t", 1, "r6", 7, "tie wins"),
]


def _snapshot(spark, **options):
    df = spark.createDataFrame(
        SNAPSHOT, "source string, load_date int, pipeline_run_id string, load_timestamp int, v string"
    )
    return sorted(r.v for r in latest_snapshot(df, ["source", "load_date"], **options).collect())


def test_latest_snapshot(spark):
    want = ["new", "new too", "null key", "only", "tie wins"]
    assert _snapshot(spark) == want


def test_latest_snapshot_is_live(spark):
    """A frame built before an append returns the run appended later."""
    schema = "load_date int, pipeline_run_id string, load_timestamp int"
    spark.createDataFrame([(1, "r1", 1)], schema).write.saveAsTable("live_snapshot")
    newest = latest_snapshot(spark.table("live_snapshot"))
    spark.createDataFrame([(1, "r2", 2), (1, None, 0)], schema).write.mode("append").saveAsTable("live_snapshot")
    again = latest_snapshot(spark.table("live_snapshot"))
    assert bag(again, "pipeline_run_id") == {("r2",): 1}
    # No winner is written into the plan when the frame is built.
    assert "LocalRelation" not in newest._jdf.queryExecution().optimizedPlan().toString()
    lone = spark.createDataFrame([(1, None, 5), (1, "old", 1)], schema)
    assert bag(latest_snapshot(lone), "pipeline_run_id") == {(None,): 1}


def test_null_key_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", None), ("a", 1)], "k string, n int")
    assert bag(null_key_groups(df, ["k", "n"])) == {(4, 3, 1): 1}
    assert bag(null_key_groups(df.where("n = 1 AND k = 'a'"), ["k", "n"])) == {(0, 0, 0): 1}
