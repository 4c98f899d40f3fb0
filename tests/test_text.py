from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockflow.functions import text

from .helpers import bag


def test_whitespace_is_what_python_strips():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@pytest.mark.parametrize(
    "raw, want",
    [
        ("On Hand", "on_hand"),
        (" On-Hand (Cs) ", "on_hand_cs"),
        ("__Qty__", "qty"),
        ("Größe %", "gr_e"),
        ("\tItem\xa0", "item"),
        ("###", ""),
    ],
)
def test_sanitize_name(raw, want):
    assert text.sanitize_name(raw) == want


def test_unique_names():
    headers = ["On Hand", "On Hand", None, "on_hand_1", "On Hand", ""]
    assert text.unique_names(headers) == [
        "on_hand", "on_hand_2", "unnamed_2", "on_hand_1", "on_hand_3", "unnamed_5",
    ]
    assert text.unique_names(["a", "A", "a "]) == ["a", "a_1", "a_2"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZ0_-. \t\n\x1c\x85\xa0 　é#"), max_size=8), min_size=1, max_size=60))
def test_columns_agree_with_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", text.strip_ws(F.col("v")), text.sanitize_col(F.col("v"))).collect()
    for v, stripped, name in rows:
        assert stripped == v.strip()
        assert name == text.sanitize_name(v)


def test_three_concatenations(spark):
    df = spark.createDataFrame([("123", "001"), ("123", None), (None, None)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select(
        text.sql_concat(a, F.lit(" "), b), text.text_combine(" ", a, b), text.amp_concat(a, b)
    )
    assert bag(got) == {
        ("123 001", "123 001", "123001"): 1,
        ("123 ", "123", None): 1,
        (" ", "", None): 1,
    }


def test_middle_segment(spark):
    cases = {
        "12-001-X": "001", "12--X": "", "12-001": None, "12": None, "a-b-c-d": "b",
        "a-b-": "b", "--": "", None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = df.select("v", text.middle_segment(F.col("v"))).collect()
    assert dict(map(tuple, got)) == cases


def test_normalized_key(spark):
    df = spark.createDataFrame([(" 00ab1\t",), ("AB1",), ("000",)], "v string")
    got = [r[0] for r in df.select(text.normalized_key(F.col("v"))).collect()]
    assert got == ["AB1", "AB1", ""]
