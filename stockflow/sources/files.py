"""Delimited and parquet files as all-string frames in file order, and their freshness."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.config import SourceConfig
from stockflow.functions.text import nullify, sanitize_name, unique_names

log = logging.getLogger(__name__)

# Position of a row: file, offset of its split in the file, running number.
ORDINAL = ("_src_file", "_src_block", "_src_row")
ROW_ID = "_src_row"
# What a line holds beyond the header's columns.
OVERFLOW = "_src_overflow"
TECHNICAL = (*ORDINAL, OVERFLOW)

_DELIMITED = ("csv", "txt", "tab")
# Headers read at a time.
HEADER_JOBS = 16


def _reader(spark: SparkSession, cfg: SourceConfig) -> DataFrameReader:
    return (
        spark.read.option("sep", "\t" if cfg.src_format == "tab" else cfg.delimiter)
        .option("encoding", cfg.encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", cfg.multi_line)
        .option("mode", "PERMISSIVE")
    )


def listed_paths(spark: SparkSession, path: str) -> list[str]:
    """The files Spark reads under ``path``, in order of their names; contents are not read."""
    found = spark.read.format("binaryFile").load(path).select("path").collect()
    return sorted(row.path for row in found)


def header_names(spark: SparkSession, cfg: SourceConfig, path: str) -> list[str] | None:
    """Sanitised names from the first line of a file; None if the file is empty.

    Only the beginning of the file is read.
    """
    first = _reader(spark, cfg).option("header", False).csv(path).first()
    if first is None:
        return None
    names = unique_names(first)
    for header, name in zip(first, names, strict=True):
        if sanitize_name(header or "") != name:
            log.warning("%s: header %r is blank or repeated, read as %s", path, header, name)
    return names


def files_by_header(spark: SparkSession, cfg: SourceConfig) -> dict[tuple[str, ...], list[str]]:
    """Files of a source by the names in their first line, first file's names first.

    Headers are small jobs over the first line of each listed file, some at a
    time; files without any line are left out.
    """
    paths = listed_paths(spark, cfg.src_path)
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        headers = list(pool.map(lambda path: header_names(spark, cfg, path), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, names in zip(paths, headers, strict=True):
        if names:
            groups.setdefault(tuple(names), []).append(path)
    if not groups:
        raise ValueError(f"{cfg.src_path} is empty")
    return groups


def _delimited(spark: SparkSession, cfg: SourceConfig, names: Sequence[str], paths: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, OVERFLOW)])
    return with_position(_reader(spark, cfg).option("header", True).schema(schema).csv(paths))


def read_source(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """One source as text, with sanitised names, nulls for NA tokens and the row ordinal.

    No type is inferred, so leading zeros survive. ``multi_line`` allows line
    breaks inside quotes and makes a file one task; leave it off for large
    extracts, which are then split. What a line of a delimited file has beyond
    the header's columns is kept in ``OVERFLOW`` for the raw gate.

    The files of a folder may have their columns in different orders, or not all
    columns: files with one header are one scan, and the scans are put together
    by name, with nulls for columns a file lacks. Every file is read once.
    """
    if cfg.src_format in _DELIMITED:
        groups = files_by_header(spark, cfg)
        scans = [_delimited(spark, cfg, names, paths) for names, paths in groups.items()]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
        names = list(dict.fromkeys(n for header in groups for n in header))
        df = df.withColumn(ROW_ID, F.monotonically_increasing_id())
        return df.select(*(nullify(F.col(n), cfg.na_tokens).alias(n) for n in names), OVERFLOW, *ORDINAL)
    if cfg.src_format == "parquet":
        df = spark.read.parquet(cfg.src_path)
        names = unique_names(df.columns)
        df = with_row_ordinal(df)
        old = [c for c in df.columns if c not in ORDINAL]
        text = [F.col(f"`{o}`").cast("string").alias(n) for o, n in zip(old, names, strict=True)]
        return df.select(*text, *ORDINAL)
    raise ValueError(f"unsupported format {cfg.src_format!r}; use csv, txt, tab, sheet or parquet")


def read_cells(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """Lines of a sheet as ``cells``, trimmed of nothing and named by nothing, with their ordinal.

    A sheet has up to ``cfg.sheet_width`` columns; what a line has beyond that is
    kept in ``OVERFLOW`` for the raw gate.
    """
    columns = [f"c{i}" for i in range(cfg.sheet_width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, OVERFLOW)])
    df = with_position(_reader(spark, cfg).option("header", False).schema(schema).csv(cfg.src_path))
    df = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    return df.select(F.array(*columns).alias("cells"), OVERFLOW, *ORDINAL)


def with_position(df: DataFrame) -> DataFrame:
    """Add file and block of each row. Only valid directly on a file scan."""
    return df.withColumns(
        {"_src_file": F.col("_metadata.file_path"), "_src_block": F.col("_metadata.file_block_start")}
    )


def with_row_ordinal(df: DataFrame) -> DataFrame:
    """Add the file position of each row. Only valid directly on a file scan."""
    return df.withColumns(
        {
            "_src_file": F.col("_metadata.file_path"),
            "_src_block": F.col("_metadata.file_block_start"),
            "_src_row": F.monotonically_increasing_id(),
        }
    )


FRESHNESS_SCHEMA = (
    "source_name string, src_path string, warn_hours double, fail_hours double, owner string, "
    "qualified string"
)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as the file system lists it: absolute, with its scheme."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return found.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()


def freshness_thresholds(spark: SparkSession, configs: Sequence[SourceConfig]) -> DataFrame:
    """Thresholds of the configured sources as a frame."""
    rows = [
        (
            c.source_name,
            c.src_path,
            None if c.warn_hours is None else float(c.warn_hours),
            None if c.fail_hours is None else float(c.fail_hours),
            c.owner,
            qualified(spark, c.src_path),
        )
        for c in configs
    ]
    return spark.createDataFrame(rows, FRESHNESS_SCHEMA)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and modification time of every file under ``root``; contents are not read.
    A root that does not exist has no files."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, modificationTime timestamp")
    return files.select("path", "modificationTime")


def _plain(path):
    """Path without the local scheme, so that 'file:/x' and '/x' are equal."""
    return F.regexp_replace(path, "^file:/+", "/")


def freshness(files: DataFrame, thresholds: DataFrame, asof: datetime) -> DataFrame:
    """Age and verdict of every source, in one job over the file listing.

    A source is its newest file at, or under, ``src_path``. Without a file it is
    MISSING even if its age is not checked; without thresholds it is SKIPPED.
    """
    listed = files.select(_plain(F.col("path")).alias("path"), "modificationTime")
    # One row per (file, folder it lies in), so that a source may be a folder.
    steps = F.split("path", "/")
    depth = F.explode(F.sequence(F.lit(1), F.size(steps)))
    located = listed.select("modificationTime", steps.alias("steps"), depth.alias("depth"))
    newest = located.groupBy(
        F.concat_ws("/", F.slice("steps", F.lit(1), F.col("depth"))).alias("at")
    ).agg(F.max("modificationTime").alias("modified"))
    path = F.col("qualified" if "qualified" in thresholds.columns else "src_path")
    wanted = thresholds.withColumn("at", F.rtrim(_plain(path), F.lit("/")))
    age = (F.lit(asof).cast("double") - F.col("modified").cast("double")) / 3600
    status = (
        F.when(F.col("modified").isNull(), "MISSING")
        .when(F.col("warn_hours").isNull() & F.col("fail_hours").isNull(), "SKIPPED")
        .when(F.col("age_hours") > F.col("fail_hours"), "FAIL")
        .when(F.col("age_hours") > F.col("warn_hours"), "WARN")
        .otherwise("PASS")
    )
    return (
        wanted.join(newest, "at", "left")
        .withColumn("age_hours", age)
        .select("source_name", "src_path", "owner", "modified", "age_hours", status.alias("status"))
    )


class StaleSourceError(ValueError):
    """The source file is older than its limit."""


def check_freshness(spark: SparkSession, cfg: SourceConfig, asof: datetime) -> None:
    """Gate of one source: raise when it is missing or too old, warn when it is late."""
    row = freshness(
        list_files(spark, cfg.src_path), freshness_thresholds(spark, [cfg]), asof
    ).first()
    if row.status == "MISSING":
        raise FileNotFoundError(cfg.src_path)
    text = f"{cfg.src_path} is {row.age_hours:.1f} hours old (owner: {cfg.owner})"
    if row.status == "FAIL":
        raise StaleSourceError(text)
    if row.status == "WARN":
        log.warning(text)
