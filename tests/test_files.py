from __future__ import annotations

import os
import random
from datetime import datetime, timezone

import pandas as pd
import pytest

from stockflow.config import CADENCE_HOURS, NA_TOKENS, SourceConfig
from stockflow.operators.quality import dq_metrics
from stockflow.operators.standardize import standardize
from stockflow.sources.files import (
    ORDINAL,
    OVERFLOW,
    TECHNICAL,
    StaleSourceError,
    check_freshness,
    freshness,
    freshness_thresholds,
    list_files,
    read_source,
)

from .helpers import bag


def config(path, **options):
    return SourceConfig("src", "cust_inventory", str(path), **options)


def content(df):
    return [tuple(r) for r in df.orderBy(*ORDINAL).drop(*TECHNICAL).collect()]


def test_csv_like_a_dataframe_reader(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        'Item, On-Hand (Cs) ,On Hand,On Hand,\n'
        '00123,"1,5",7 ,NA,x\n'
        '\n'
        '"a ""q"" b","line\nbreak",,null,\n'
        ' padded ,"",N/A,0,last\n'
    )
    df = read_source(spark, config(path, multi_line=True))
    assert df.columns[:5] == ["item", "on_hand_cs", "on_hand", "on_hand_1", "unnamed_4"]
    assert all(t == "string" for c, t in df.dtypes if c not in ORDINAL)
    want = pd.read_csv(path, dtype=str, index_col=False)
    want = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert content(df) == want


def test_na_tokens_are_the_reader_defaults(spark, tmp_path):
    path = tmp_path / "na.csv"
    path.write_text("k,v\n" + "".join(f"{i},{t}\n" for i, t in enumerate(NA_TOKENS)) + "x,NAN\n")
    assert bag(read_source(spark, config(path)).where("v IS NOT NULL"), "k") == {("x",): 1}
    kept = read_source(spark, config(path, na_tokens=("",)))
    assert kept.where("v = 'NA'").count() == 1


@pytest.mark.parametrize("fmt, sep", [("txt", "|"), ("tab", "\t")])
def test_other_delimiters_and_encoding(spark, tmp_path, fmt, sep):
    path = tmp_path / f"a.{fmt}"
    path.write_bytes(f"Größe{sep}b\né{sep}2\n".encode("latin-1"))
    df = read_source(spark, config(path, src_format=fmt, delimiter="|", encoding="ISO-8859-1"))
    assert df.columns[:2] == ["gr_e", "b"] and content(df) == [("é", "2")]


def test_parquet_as_text(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(7, "x")], "`Item No` int, b string").write.parquet(path)
    df = read_source(spark, config(path, src_format="parquet"))
    assert df.columns[:2] == ["item_no", "b"] and content(df) == [("7", "x")]


def test_unsupported_format(spark, tmp_path):
    with pytest.raises(ValueError, match="excel"):
        read_source(spark, config(tmp_path, src_format="excel"))


def test_last_line_wins_over_many_splits(spark, tmp_path):
    """The ordinal is the file order even when the file is read by many tasks."""
    random.seed(3)
    rows = [(f"k{random.randrange(40)}", str(i)) for i in range(4000)]
    path = tmp_path / "big.csv"
    path.write_text("item,qty\n" + "".join(f"{k},{v}\n" for k, v in rows))
    cfg = config(path, multi_line=False, business_key=("item",), quantity_columns=("qty",))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_source(spark, cfg)
        assert df.rdd.getNumPartitions() > 8
        assert [v for _, v in content(df)] == [v for _, v in rows]
        kept = standardize(df, cfg).kept.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.item: r.qty for r in kept} == {k: int(v) for k, v in rows}


NOW = datetime(2026, 5, 18, 14, tzinfo=timezone.utc)


def aged(path, hours):
    path.write_text("a\n1\n")
    stamp = NOW.timestamp() - hours * 3600
    os.utime(path, (stamp, stamp))
    return path


def test_freshness_of_all_sources_at_once(spark, tmp_path):
    folder = tmp_path / "folder"
    folder.mkdir()
    aged(folder / "old.csv", 100)
    aged(folder / "new.csv", 1)
    limits = {"warn_hours": 30, "fail_hours": 54}
    cases = {
        "fresh": (aged(tmp_path / "a.csv", 29), limits), "late": (aged(tmp_path / "b.csv", 31), limits),
        "stale": (aged(tmp_path / "c.csv", 55), limits), "gone": (tmp_path / "nope.csv", limits),
        "unchecked": (aged(tmp_path / "d.csv", 9999), dict(zip(("warn_hours", "fail_hours"), CADENCE_HOURS["ad_hoc"]))),
        "folder": (folder, limits),
        "only_fail": (aged(tmp_path / "e.csv", 31), {"warn_hours": None, "fail_hours": 54}),
    }
    configs = [SourceConfig(n, "d", str(p), **w) for n, (p, w) in cases.items()]
    got = freshness(list_files(spark, str(tmp_path)), freshness_thresholds(spark, configs), NOW)
    assert {r.source_name: r.status for r in got.collect()} == {
        "fresh": "PASS", "late": "WARN", "stale": "FAIL", "gone": "MISSING", "unchecked": "SKIPPED", "folder": "PASS", "only_fail": "PASS",
    }


def test_long_lines(spark, tmp_path):
    """A value beyond the header's columns is kept apart for the raw gate, not dropped."""
    path = tmp_path / "long.csv"
    path.write_text("item,qty\n1,2\n3,4,LOST\n5\n")
    read = read_source(spark, config(path))
    assert bag(read, "item", "qty", OVERFLOW) == {("1", "2", None): 1, ("3", "4", "LOST"): 1, ("5", None, None): 1}
    gate = dq_metrics(read.drop(*ORDINAL), expected=("item", "qty"), overflow=OVERFLOW)
    assert bag(gate.where("check_name = 'malformed'"), "value", "status") == {(1, "FAIL"): 1}
    assert gate.count() == 3


def test_files_with_headers_of_their_own(spark, tmp_path):
    """Files of one folder are read by their own header, one scan for each header."""
    folder = tmp_path / "many files"
    folder.mkdir()
    (folder / "a.csv").write_text("Item,Qty\n1,2\n1,3\n")
    (folder / "b.csv").write_text("qty,item\n4,3\n")
    (folder / "c.csv").write_text("item,qty,Shelf\n5,6,s,MORE\n")
    (folder / "d.csv").write_text("Item,Qty\n7,8\n")
    (folder / "e.csv").write_text("")
    (folder / "_hidden.csv").write_text("other\n1\n")
    df = read_source(spark, config(folder))
    assert df.columns == ["item", "qty", "shelf", OVERFLOW, *ORDINAL]
    assert bag(df, "item", "qty", "shelf", OVERFLOW) == {
        ("1", "2", None, None): 1, ("1", "3", None, None): 1, ("3", "4", None, None): 1,
        ("5", "6", "s", "MORE"): 1, ("7", "8", None, None): 1,
    }
    assert df.select("_src_row").distinct().count() == 5
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3
    kept = standardize(df, config(folder, business_key=("item",), quantity_columns=("qty",))).kept
    assert bag(kept, "item", "qty") == {("1", 3): 1, ("3", 4): 1, ("5", 6): 1, ("7", 8): 1}
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "a.csv").write_text("")
    with pytest.raises(ValueError, match="is empty"):
        read_source(spark, config(empty))


def test_a_source_is_read_once(spark, tmp_path):
    """Finding the headers does not read the files a second time."""
    folder = tmp_path / "large"
    folder.mkdir()
    for name, header in (("a", "item,qty"), ("b", "qty,item")):
        (folder / f"{name}.csv").write_text(header + "\n" + "123456,789012\n" * 300_000)
    size = sum(p.stat().st_size for p in folder.iterdir())

    def read():
        stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(s.getBytesRead() for s in stats if s.getScheme() == "file")

    before = read()
    assert read_source(spark, config(folder)).where("item IS NULL").count() == 0
    assert size <= read() - before < 1.3 * size


def test_freshness_of_relative_and_qualified_paths(spark, tmp_path):
    path = aged(tmp_path / "r.csv", 1)
    check_freshness(spark, config(os.path.relpath(path)), NOW)
    check_freshness(spark, config(f"file://{path}"), NOW)
    with pytest.raises(FileNotFoundError):
        check_freshness(spark, config("missing/r.csv"), NOW)


def test_freshness_gate(spark, tmp_path):
    check_freshness(spark, config(aged(tmp_path / "a.csv", 31)), NOW)
    with pytest.raises(StaleSourceError, match="55.0 hours"):
        check_freshness(spark, config(aged(tmp_path / "b.csv", 55)), NOW)
    with pytest.raises(FileNotFoundError):
        check_freshness(spark, config(tmp_path / "nope.csv"), NOW)
    check_freshness(spark, config(aged(tmp_path / "c.csv", 999), warn_hours=None, fail_hours=None), NOW)
