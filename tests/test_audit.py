from __future__ import annotations

from stockflow.config import SourceConfig
from stockflow.plans.audit import (
    REGISTER_COLUMNS,
    shared_source_members,
    shared_sources,
    source_audit,
)
from stockflow.sources.files import read_source

from .helpers import bag

HEADER = "Main File Name,Sub Query / File Name,Data Purpose,Customer,Data / File Path,Sheet / Table Name,Refresh Frequency,Manual v Auto,Redundant (Y/N/Maybe),In Fabric (Y/N/Maybe),Notes,MCode Audit,MCode Notes"
LINES = [
    'Book A,Q1,,,"share/x, y.xlsx",S1,Daily,PowerQuery,,Yes,"two\nlines, ""quoted""",Done,',
    'Book A,Q2,,,"share/x, y.xlsx",S1,Daily,,Maybe,,,Done,',
    "Book B,Q2,,,share/x.xlsx,,,,,,,Done,",
    "Book B,Q3,,,share/x.xlsx,,,Manual,,,,Done,",
    "Book B,Q3,,,ODBC;DSN=erp,,,,,,,,",
    ",,,,,,,,,,,,",
    ",,,,,,,,,,,,",
]


def test_register_from_file(spark, tmp_path):
    path = tmp_path / "register.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    register = read_source(spark, SourceConfig("register", "audit", str(path), multi_line=True))
    assert [c for c in register.columns if not c.startswith("_src")] == list(REGISTER_COLUMNS)
    assert register.where("notes LIKE 'two%'").first().notes == 'two\nlines, "quoted"'

    audit = {(r.dimension, r.value): (r.n_rows, r.n_queries) for r in source_audit(register).collect()}
    assert audit[("total", None)] == (5, 3)
    assert audit[("workbook", "Book B")] == (3, 2)
    assert audit[("migrated", "Yes")] == (1, 1)
    assert audit[("odbc", "Yes")] == (1, 1)
    assert audit[("delivery", None)] == (3, 2)
    assert bag(shared_sources(register)) == {("share/x, y.xlsx", "S1", 2, 2): 1, ("share/x.xlsx", None, 2, 2): 1}
    assert bag(shared_source_members(register), "data_file_path", "sub_query_file_name") == {
        ("share/x, y.xlsx", "Q1"): 1, ("share/x, y.xlsx", "Q2"): 1, ("share/x.xlsx", "Q2"): 1, ("share/x.xlsx", "Q3"): 1,
    }
