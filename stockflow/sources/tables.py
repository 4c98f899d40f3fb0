"""Governed tables, partitioned by load date and run; and the upload file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.config import LAYERS, RunContext


def ensure_schemas(spark: SparkSession, names: Iterable[str] = LAYERS) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def append_table(
    df: DataFrame, table: str, partition: str | None = "load_date", table_format: str = "parquet"
) -> None:
    """Append, never overwrite. A schema that differs from the table's is an error."""
    writer = df.write.format(table_format).mode("append")
    if partition:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(table)


# Partition columns of a governed table: what one run wrote is one partition.
RUN_PARTITIONS = ("load_date", "pipeline_run_id")


class SchemaMismatchError(ValueError):
    """The rows do not have the table's columns and types."""


def commit_run(
    spark: SparkSession, df: DataFrame, table: str, ctx: RunContext, table_format: str = "parquet"
) -> None:
    """Make ``df`` the rows of this run in ``table``; other runs' rows are never touched.

    A run that is repeated under its id replaces its own partition, also by
    nothing, and what it left under another date goes, so a rerun leaves the
    table as a first run would. ``df`` has the audit columns. Runs with different
    ids may commit at the same time.
    """
    if not spark.catalog.tableExists(table):
        empty = df.where(F.lit(False)).write.format(table_format)
        empty.partitionBy(*RUN_PARTITIONS).saveAsTable(table)
    kinds = [k for k in spark.table(table).dtypes if k[0] not in RUN_PARTITIONS]
    if sorted(k for k in df.dtypes if k[0] not in RUN_PARTITIONS) != sorted(kinds):
        raise SchemaMismatchError(f"{table} has {kinds}, the rows {df.dtypes}")
    rows = df.select(*(F.col(f"`{name}`") for name, _ in kinds))
    day, run = f"DATE '{ctx.load_date}'", _text(ctx.run_id)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (load_date = {day}, pipeline_run_id = {run})"
        " SELECT * FROM {rows}",
        rows=rows,
    )
    if table_format != "parquet":
        return
    for row in spark.sql(f"SHOW PARTITIONS {table} PARTITION (pipeline_run_id = {run})").collect():
        date = row.partition.split("/")[0].removeprefix("load_date=")
        if date != str(ctx.load_date):
            spec = f"load_date = DATE '{date}', pipeline_run_id = {run}"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _text(value: str) -> str:
    """``value`` as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class WriteMismatchError(RuntimeError):
    """The table does not hold the rows that were handed to the writer."""


def run_rows(spark: SparkSession, table: str, ctx: RunContext) -> DataFrame:
    """Rows of this run; only its own partition is read."""
    same_day = F.col("load_date") == F.lit(ctx.load_date)
    return spark.table(table).where(same_day & (F.col("pipeline_run_id") == ctx.run_id))


def verify_write(spark: SparkSession, table: str, ctx: RunContext, expected: int) -> int:
    found = run_rows(spark, table, ctx).count()
    if found != expected:
        raise WriteMismatchError(f"{table}: {found} rows of run {ctx.run_id}, expected {expected}")
    return found


def new_folder(spark: SparkSession, path: str) -> None:
    """Raise if ``path`` exists, so that a run that cannot write its file fails before it appends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        raise FileExistsError(path)


def write_upload(
    df: DataFrame,
    path: str,
    files: int | None = 1,
    max_records: int | None = None,
    replace: bool = False,
) -> None:
    """Write the upload as CSV with a header line.

    The contract is one file, so one task writes it. ``files`` states another
    number; None keeps the frame's partitions, so that no rows move.
    ``max_records`` bounds the rows of a file. ``replace`` is for a run that is
    repeated and writes its own folder again.
    """
    if files is not None:
        df = df.repartition(files) if files > 1 else df.coalesce(1)
    writer = df.write.mode("overwrite" if replace else "errorifexists").option("header", True)
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.csv(path)
