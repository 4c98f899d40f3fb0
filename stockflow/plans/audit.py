"""Audit of the register of source queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of the register, as sanitised names.
REGISTER_COLUMNS = (
    "main_file_name", "sub_query_file_name", "data_purpose", "customer", "data_file_path",
    "sheet_table_name", "refresh_frequency", "manual_v_auto", "redundant_y_n_maybe",
    "in_fabric_y_n_maybe", "notes", "mcode_audit", "mcode_notes",
)
QUERY, PATH, SHEET = "sub_query_file_name", "data_file_path", "sheet_table_name"

# What the audit counts by: report label -> register column.
DIMENSIONS = {
    "workbook": "main_file_name",
    "redundant": "redundant_y_n_maybe",
    "migrated": "in_fabric_y_n_maybe",
    "delivery": "manual_v_auto",
    "refresh": "refresh_frequency",
}


def records(register: DataFrame) -> DataFrame:
    """Register without records that are blank in every column."""
    filled = reduce(
        lambda a, b: a | b, (F.coalesce(F.col(c), F.lit("")) != "" for c in REGISTER_COLUMNS)
    )
    return register.where(filled)


def mentions_odbc() -> Column:
    return F.coalesce(F.lower(F.col(PATH)).contains("odbc"), F.lit(False))


def source_audit(register: DataFrame) -> DataFrame:
    """Rows and distinct queries: in total, by each dimension, and with an ODBC source.

    Long form ``(dimension, value, n_rows, n_queries)`` from one pass. Rows are
    counted per query and dimension values first, so the copies made for the
    dimensions are copies of that reduced result.
    """
    odbc = F.when(mentions_odbc(), "Yes").otherwise("No").alias("odbc")
    per_query = (
        records(register)
        .groupBy(F.col(QUERY), odbc, *(F.col(c) for c in DIMENSIONS.values()))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = [("total", F.lit(None).cast("string")), ("odbc", F.col("odbc"))]
    cells += [(label, F.col(c)) for label, c in DIMENSIONS.items()]
    cell = F.array(*(F.struct(F.lit(d).alias("dimension"), v.alias("value")) for d, v in cells))
    return (
        per_query.select(QUERY, "n", F.inline(cell))
        .groupBy("dimension", "value", QUERY)
        .agg(F.sum("n").alias("n"))
        .groupBy("dimension", "value")
        .agg(F.sum("n").alias("n_rows"), F.count(QUERY).alias("n_queries"))
    )


def shared_sources(register: DataFrame) -> DataFrame:
    """Path and sheet used by more than one query, with the number of rows and queries.

    The members come from ``shared_source_members``, one row each, so a source
    that many queries share is never gathered in one row.
    """
    return (
        _uses(register)
        .groupBy(PATH, SHEET)
        .agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_queries"))
        .where(F.col("n_queries") > 1)
    )


def _uses(register: DataFrame) -> DataFrame:
    used = records(register).where(F.coalesce(F.col(PATH), F.lit("")) != "")
    return used.groupBy(PATH, SHEET, QUERY).agg(F.count(F.lit(1)).alias("n_rows"))


def shared_source_members(register: DataFrame) -> DataFrame:
    """Every query of every shared path and sheet."""
    shared = shared_sources(register).select(
        F.col(PATH).alias("__path"), F.col(SHEET).alias("__sheet")
    )
    match = [F.col(PATH) == F.col("__path"), F.col(SHEET).eqNullSafe(F.col("__sheet"))]
    return _uses(register).join(shared, match, "left_semi")
