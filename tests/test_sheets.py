"""Sheets: header detection per file, rows by their own columns, and the way through ingest."""

from __future__ import annotations

from datetime import datetime

import pytest

from stockflow.config import PLATFORM_ZONE, RunContext, SourceConfig
from stockflow.operators.distributor import sheet_step
from stockflow.operators.quality import DataQualityError
from stockflow.plans.ingest import ingest
from stockflow.sources.files import read_cells
from stockflow.sources.operations import RUN_LOG
from stockflow.sources.sheets import NoHeaderError, detect_headers, mapped_rows, sheet_source

from .helpers import bag, one

NORTH = """Inventory report,,,
as of 2031-03-04,,,

Site,Note,Item No,On-Hand Qty
ABQ,x,00A,"1,5"
ABQ,,00B,3
 ATL ,n,00B,4.5
Site,Note,Item No,On-Hand Qty
DAL,,C,1
,,D,2
,,,
ABQ,,,12
"""
SOUTH = """Stock;on hand per item no
"Stock","Item No","Site"
7,00C,ABQ
8,00C,ABQ
"""
_count = iter(range(100))


@pytest.fixture
def cfg(spark, tmp_path):
    folder = tmp_path / "sheets"
    folder.mkdir()
    (folder / "north.csv").write_text(NORTH)
    (folder / "south.csv").write_text(SOUTH)
    locations = spark.createDataFrame([("ABQ", "c 001"), ("ATL", "c 002"), ("ATL", "c 009"), ("X", None)], "code string, customer string")
    return SourceConfig(
        f"sheet{next(_count)}", "cust_inventory", str(folder), src_format="sheet",
        expected_columns=("site", "item_no", "on_hand_qty"), required_columns=("site", "item_no", "on_hand_qty"),
        aliases={"stock": "on_hand_qty"}, renames={"site": "location", "item_no": "item"},
        business_key=("location", "item"), text_columns=("location", "item"), custom=sheet_step(locations),
        warn_hours=None, fail_hours=None,
    )


def test_headers_are_found_per_file(spark, cfg):
    lines = read_cells(spark, cfg)
    found = detect_headers(lines, cfg.expected_columns, cfg.required_columns, cfg.aliases)
    heads = {r._src_file.split("/")[-1]: [n for n in r.header if n] for r in found.collect()}
    assert heads == {"north.csv": ["site", "note", "item_no", "on_hand_qty"], "south.csv": ["on_hand_qty", "item_no", "site"]}
    sheet = mapped_rows(lines, found, cfg.expected_columns, cfg.aliases)
    assert bag(sheet.rows, "site", "item_no", "on_hand_qty") == {
        ("ABQ", "00A", "1,5"): 1, ("ABQ", "00B", "3"): 1, (" ATL ", "00B", "4.5"): 1, ("DAL", "C", "1"): 1,
        (None, "D", "2"): 1, ("ABQ", None, "12"): 1, ("ABQ", "00C", "7"): 1, ("ABQ", "00C", "8"): 1,
    }
    kinds = {(r._src_file.split("/")[-1], r.kind): r.n_lines for r in sheet.left_out.collect()}
    assert kinds[("north.csv", "HEADER")] == 2 and kinds[("south.csv", "TITLE")] == 1 and kinds[("north.csv", "BLANK")] == 1
    assert sheet.rows.count() + sum(kinds.values()) == lines.count()


def test_best_line_and_first_of_equals(spark):
    lines = spark.createDataFrame(
        [("f", 0, 0, ["item", None]), ("f", 0, 1, ["Item", "SITE"]), ("f", 0, 2, ["site", "item"]), ("f", 5, 1, ["v", "w"]), ("g", 0, 0, ["site"]), ("g", 0, 1, [])],
        "_src_file string, _src_block long, _src_row long, cells array<string>",
    )
    found = {r._src_file: (r.header, r.at_row) for r in detect_headers(lines, ("item", "site"), ("item", "site")).collect()}
    assert found == {"f": (["item", "site"], 1), "g": (None, 0)}


def test_sheets_through_ingest(spark, cfg):
    ctx = RunContext(f"{cfg.source_name}-1", datetime(2031, 3, 4, 9, tzinfo=PLATFORM_ZONE))
    result = ingest(spark, cfg, ctx)
    assert (result.rows_raw, result.rows_stg) == (6 + 2, 3)
    raw = spark.table(cfg.raw_table)
    assert bag(raw.where("site = ' ATL '"), "item_no", "on_hand_qty") == {("00B", "4.5"): 1}  # unmodified
    assert bag(spark.table(cfg.stg_table), "location", "item", "on_hand_qty", "reported_location") == {
        ("c 001", "00B", 3, "ABQ"): 1, ("c 002", "00B", 5, "ATL"): 1, ("c 001", "00C", 8, "ABQ"): 1,
    }
    assert bag(spark.table(cfg.rejects_table), "item", "reported_location", "reported_on_hand", "reason") == {
        ("00A", "ABQ", "1,5", "BAD_QUANTITY"): 1, ("C", "DAL", "1", "UNMAPPED_LOCATION"): 1, ("D", None, "2", "NO_LOCATION"): 1,
        (None, "ABQ", "12", "NO_ITEM"): 1, ("00C", "ABQ", "7", "DUPLICATE_KEY"): 1,
    }
    row = one(spark.table(RUN_LOG).where(f"source_name = '{cfg.source_name}'"))
    assert (row.status, row.rows_raw, row.rows_stg) == ("SUCCESS", 8, 3)
    ingest(spark, cfg, ctx)
    assert spark.table(cfg.rejects_table).count() == 5


def test_a_file_without_header_fails_the_run(spark, cfg):
    from pathlib import Path

    (Path(cfg.src_path) / "west.csv").write_text("Site,Item No\nABQ,1\n")
    with pytest.raises(NoHeaderError, match="west.csv"):
        ingest(spark, cfg)
    row = one(spark.table(RUN_LOG).where(f"source_name = '{cfg.source_name}'"))
    assert row.status == "FAILURE" and not spark.catalog.tableExists(cfg.raw_table)


def test_a_hot_file_is_not_one_task(spark, cfg, monkeypatch):
    """Rows find their file's header by a broadcast of one row per file, or by a join that can be split."""
    from stockflow.sources import sheets

    lines = read_cells(spark, cfg)
    plan = sheet_source(lines, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    monkeypatch.setattr(sheets, "BROADCAST_FILES", 0)
    assert bag(sheet_source(lines, cfg), "item_no") == bag(sheet_source(lines, cfg), "item_no")


def test_long_lines_fail_the_gate(spark, cfg):
    from dataclasses import replace
    from pathlib import Path

    with (Path(cfg.src_path) / "north.csv").open("a") as file:
        file.write("ABQ,,Z,1,MORE\n")
    with pytest.raises(DataQualityError, match="malformed"):
        ingest(spark, replace(cfg, sheet_width=4))
