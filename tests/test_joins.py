from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockflow.operators.joins import (
    JoinSide,
    fanout_metrics,
    lookup,
    differing_ranges,
    reconcile,
    reconcile_changes,
    spread_join,
)

from stockflow.operators.keyed import dedupe_last, first_match
from stockflow.plans import supply

from .helpers import bag, one

_key = st.sampled_from([None, 1, 2, 3])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=8, deadline=None)
@given(st.lists(_key, max_size=12), st.lists(_key, max_size=6))
def test_lookup_is_a_left_join(spark, left, right):
    l = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, id int")
    r = spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(right)], "rk int, v string")
    want = Counter()
    for i, k in enumerate(left):
        matches = [j for j, x in enumerate(right) if k is not None and x == k]
        for j in matches:
            want[(k, i, k, f"v{j}")] += 1
        if not matches:
            want[(k, i, None, None)] += 1
    assert bag(lookup(l, r, [("k", "rk")])) == want
    assert bag(lookup(l, r, [("k", "rk")], spread_by=["id"])) == want


def test_lookup_spreads_rows_without_a_key(spark):
    """In a shuffled join, null keys reach more than one partition."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        l = spark.range(2000).selectExpr("if(id < 1900, null, id) AS k", "id")
        r = spark.range(100).selectExpr("id + 1900 AS rk", "'v' AS v")
        joined = lookup(l, r, [("k", "rk")], spread_by=["id"])
        text = plan(joined)
        assert "SortMergeJoin [k" in text and "__bucket" in text.split("SortMergeJoin", 1)[1].split("]", 1)[0]
        sizes = joined.where("k IS NULL").rdd.glom().map(len).collect()
        assert sum(sizes) == 1900 and max(sizes) < 900
        assert joined.where("v IS NOT NULL").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture
def shuffled_and_small(spark):
    """Thresholds scaled down so that adaptive execution sees skew in a small frame."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k in values:
        spark.conf.unset(k)


def hot(spark):
    """A third of the rows share one key."""
    return spark.range(0, 60_000, 1, 6).selectExpr("if(id % 3 = 0, 7, id % 1000) AS k", "id", "uuid() AS pad")


def test_hot_key_of_a_lookup_is_split(spark, shuffled_and_small):
    joined = lookup(hot(spark), spark.range(1000).selectExpr("id AS rk", "id * 2 AS v"), [("k", "rk")])
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan(joined)


def test_hot_key_of_a_first_match_is_split(spark, shuffled_and_small):
    """Also when the right side comes out of a window over the join key."""
    right = spark.range(3000).selectExpr("id % 1000 AS rk", "id AS v")
    joined = first_match(hot(spark), right, [("k", "rk")], [F.col("v").asc()], ["v"])
    rows = joined.collect()
    assert len(rows) == 60_000 and all(r.v == r.k for r in rows)
    assert "skew=true" in plan(joined)


def test_hot_sku_of_the_crosswalk_is_split(spark, shuffled_and_small):
    inventory = hot(spark).selectExpr("'c 001' AS location", "CAST(k AS STRING) AS item", "pad")
    entries = spark.range(1000).selectExpr(
        "'SA' AS Company", "'L' AS BuyListCode", "CAST(id AS STRING) AS ItemCode", "CAST(id AS STRING) AS StateReferenceNumber",
        "'1' AS BuylistItemStatus", "CAST(id AS STRING) AS CustomerCrossReference", "'c' AS Customer", "'001' AS CustomerDeliveryAddressCode",
        "'n' AS CustomerFullName", "'k' AS BuyListDetailKey",
    )
    joined = supply.crosswalk_join(inventory, supply.crosswalk(entries))
    rows = joined.collect()
    assert len(rows) == 60_000 and all(r.CATN32 == r.item for r in rows)
    assert "skew=true" in plan(joined)


def test_two_joins_on_one_hot_key_are_both_split(spark, shuffled_and_small):
    """The second join does not lean on the partitioning of the first."""
    first = spark.range(1000).selectExpr("id AS a", "id AS va")
    second = spark.range(1000).selectExpr("id AS b", "id AS vb")
    joined = lookup(spread_join(hot(spark), first, [("k", "a")], "inner"), second, [("k", "b")])
    assert len(joined.collect()) == 60_000
    assert plan(joined).split("Initial Plan")[0].count("skew=true") == 2


def test_rejects_of_a_hot_key_do_not_gather(spark, shuffled_and_small):
    """Repeats are found by row id, so the largest task holds far less than the hot key."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rejected = dedupe_last(hot(spark), ["k"], ["id"], "id").rejected
        sizes = rejected.rdd.glom().map(len).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 60_000 - 1000 and max(sizes) < 20_000


def test_fanout_counts_equal_the_join(spark):
    l = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "a int")
    r = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (9,)], "b int")
    m = one(fanout_metrics([JoinSide("j", l, r, [("a", "b")])]))
    joined = l.join(r, l.a == r.b, "left").count()
    assert (m.join_name, m.rows_before, m.rows_after, m.rows_unmatched, m.max_matches) == ("j", 5, joined, 2, 3)
    empty = one(fanout_metrics([JoinSide("e", l.limit(0), r, [("a", "b")])]))
    assert (empty.rows_before, empty.rows_after, empty.max_matches) == (0, 0, 0)


def test_reconcile(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "k string")
    assert bag(reconcile(a, b, ["k"])) == {
        ("COUNT_DIFFERS", 1, 2, 1): 1, ("ONLY_A", 1, 1, 0): 1, ("ONLY_B", 1, 0, 1): 1, ("SAME", 1, 1, 1): 1,
    }
    assert bag(reconcile(a, a, ["k"]), "status") == {("SAME",): 1}


def changes(a, b):
    """Plain version of ``reconcile_changes`` for rows (k, x, y)."""
    left, right = Counter(a), Counter(b)
    out = Counter()
    for k in {r[0] for r in (*a, *b)}:
        gone = {r: n for r, n in (left - right).items() if r[0] == k}
        new = {r: n for r, n in (right - left).items() if r[0] == k}
        if list(gone.values()) == [1] == list(new.values()):
            (old,), (now,) = gone, new
            for name, x, y in zip("xy", old[1:], now[1:], strict=True):
                if x != y:
                    out[(k, "CHANGED", name, None if x is None else str(x), None if y is None else str(y), 1)] += 1
        else:
            for status, rows in (("ONLY_A", gone), ("ONLY_B", new)):
                for n in rows.values():
                    out[(k, status, None, None, None, n)] += 1
    return out


_row = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, 1, 2]), st.sampled_from([None, "a"]))


@settings(max_examples=8, deadline=None)
@given(st.lists(_row, max_size=8), st.lists(_row, max_size=8))
def test_reconcile_changes(spark, a, b):
    left, right = (spark.createDataFrame(r, "k int, x int, y string") for r in (a, b))
    assert bag(reconcile_changes(left, right, ["k"])) == changes(a, b)


def test_only_ranges_that_differ_are_compared(spark):
    left = spark.range(5000).selectExpr("id AS k", "id % 7 AS x")
    same = left.repartition(7)
    assert differing_ranges(left, same, ["k"]).isEmpty() and reconcile_changes(left, same, ["k"]).isEmpty()
    right = left.withColumn("x", F.expr("CASE WHEN k IN (17, 4000) THEN -1 ELSE x END"))
    assert differing_ranges(left, right, ["k"]).count() == 2
    assert bag(reconcile_changes(left, right, ["k"]), "k", "value_a", "value_b") == {(17, "3", "-1"): 1, (4000, "3", "-1"): 1}
    # Values that move from one column to another, or between null and empty, are differences.
    a, b = (spark.createDataFrame([r], "k int, x string, y string") for r in ((1, None, "v"), (1, "v", None)))
    assert reconcile_changes(a, b, ["k"]).count() == 2
    with pytest.raises(ValueError, match="columns differ"):
        reconcile_changes(a, b.drop("y"), ["k"])
