from __future__ import annotations

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockflow.functions.numbers import lost_in_parse, to_number, to_quantity

CASES = {
    "1.2": 2, " 7 ": 7, "-1.5": -1, "-0.2": 0, "1e3": 1000, "+4": 4, ".5": 1, "5.": 5,
    "1,234": None, "12d": None, "inf": None, "-Infinity": None, "NaN": None, "": None,
    "1e999": None, "1e30": None, "0x10": None, None: None, "\xa012\t": 12,
}


def test_cases(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "v string")
    q = df.select("v", to_quantity(F.col("v")).alias("q"))
    assert q.schema["q"].dataType.simpleString() == "bigint"
    assert dict(map(tuple, q.collect())) == CASES


def test_lost_counts_only_text_that_was_there(spark):
    df = spark.createDataFrame([("1,2",), (None,), ("3",)], "v string")
    assert [r[0] for r in df.select(lost_in_parse(F.col("v"))).collect()] == [True, False, False]


def test_number_keeps_fraction(spark):
    df = spark.createDataFrame([("2.25",), ("x",), ("1e999",)], "v string")
    assert [r[0] for r in df.select(to_number(F.col("v"))).collect()] == [2.25, None, None]


_number_like = st.text(alphabet=st.sampled_from("0123456789.,+-eEd "), max_size=7)


@settings(max_examples=5, deadline=None)
@given(st.lists(_number_like, min_size=1, max_size=80))
def test_agrees_with_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for v, got in df.select("v", to_quantity(F.col("v"))).collect():
        parsed = pd.to_numeric(pd.Series([v], dtype=object), errors="coerce").iloc[0]
        finite = pd.notna(parsed) and math.isfinite(parsed) and abs(parsed) < 9.2e18
        want = math.ceil(parsed) if finite else None
        assert got == want, v
