"""Sheets whose header is not the first line, and not the same in every file.

Every line is scored by how many of the wanted names its cells hold. The best
line of a file is its header and says where that file keeps each column; what
stands above it are title lines.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.config import SourceConfig
from stockflow.functions.text import nullify, sanitize_col
from stockflow.sources.files import ORDINAL, OVERFLOW, ROW_ID

log = logging.getLogger(__name__)

# Headers are one row per file; up to so many are sent to every task.
BROADCAST_FILES = 10_000


class NoHeaderError(ValueError):
    """A file has no line with all required names."""


class Sheet(NamedTuple):
    """Data rows under the wanted names; counts of title lines and repeated headers per file."""

    rows: DataFrame
    left_out: DataFrame


def named_cells(cells: Column, aliases: Mapping[str, str]) -> Column:
    """Cells as identifiers, under the wanted name where another is known."""

    def name(cell: Column) -> Column:
        plain = sanitize_col(cell)
        if not aliases:
            return plain
        known = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
        return F.coalesce(F.try_element_at(known, plain), plain)

    return F.transform(cells, name)


def detect_headers(
    lines: DataFrame,
    wanted: Sequence[str],
    required: Sequence[str],
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """``_src_file, header, at_block, at_row``: the header of each file, names null where none fits.

    The line that holds most of the ``wanted`` names, the first of equals, if it
    holds all ``required`` ones. One aggregate that keeps one line per file and task.
    """
    names = named_cells(F.col("cells"), aliases or {})
    score = F.size(F.array_intersect(names, F.array(*(F.lit(w) for w in wanted))))
    place = F.struct(score.alias("score"), (-F.col("_src_block")).alias("b"), (-F.col(ROW_ID)).alias("r"))
    line = F.struct(names.alias("names"), F.col("_src_block").alias("block"), F.col(ROW_ID).alias("row"))
    best = lines.groupBy("_src_file").agg(F.max_by(line, place).alias("best"))
    fits = F.size(F.array_except(F.array(*(F.lit(r) for r in required)), F.col("best.names"))) == 0
    return best.select(
        "_src_file",
        F.when(fits, F.col("best.names")).alias("header"),
        F.col("best.block").alias("at_block"),
        F.col("best.row").alias("at_row"),
    )


def mapped_rows(
    lines: DataFrame,
    headers: DataFrame,
    wanted: Sequence[str],
    aliases: Mapping[str, str] | None = None,
    na_tokens: Sequence[str] = ("",),
) -> Sheet:
    """Lines below their file's header, each wanted column taken from where that file has it.

    A column that a file lacks is null; a name that occurs twice is the first.
    Lines that repeat the header and lines without any value are left out.
    """
    head = headers.withColumnRenamed("_src_file", "__file")
    placed = lines.join(head, F.col("_src_file") == F.col("__file"))
    here = F.struct("_src_block", ROW_ID)
    above = here < F.struct("at_block", "at_row")
    repeated = named_cells(F.col("cells"), aliases or {}) == F.col("header")
    blank = F.forall("cells", lambda c: F.coalesce(sanitize_col(c) == "", F.lit(True)))
    kind = F.when(above, "TITLE").when(repeated, "HEADER").when(blank, "BLANK")
    data = placed.where(kind.isNull())
    columns = []
    for name in wanted:
        at = F.array_position("header", name).cast("int") - 1
        value = F.when(at >= 0, F.get("cells", at))
        columns.append(nullify(value, na_tokens).alias(name))
    more = [c for c in (OVERFLOW, *ORDINAL) if c in lines.columns]
    left_out = placed.groupBy("_src_file", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_lines"))
    return Sheet(data.select(*columns, *more), left_out.where("kind IS NOT NULL"))


def sheet_source(lines: DataFrame, cfg: SourceConfig) -> DataFrame:
    """Rows of all files of a sheet source under ``cfg.expected_columns``.

    ``lines`` are the stored lines of ``read_cells``, read once for the headers
    and once for the rows. A file without a header line fails the source.
    """
    wanted = cfg.expected_columns or cfg.required_columns
    headers = detect_headers(lines, wanted, cfg.required_columns, cfg.aliases)
    found = headers.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("header").isNull(), F.col("_src_file"))).alias("bad")).first()
    if found.bad is not None:
        raise NoHeaderError(f"{found.bad}: no line holds {', '.join(cfg.required_columns)}")
    if found.n <= BROADCAST_FILES:
        headers = F.broadcast(headers)
    sheet = mapped_rows(lines, headers, wanted, cfg.aliases, cfg.na_tokens)
    for row in sheet.left_out.groupBy("kind").agg(F.sum("n_lines").alias("n")).collect():
        log.info("%s: %d lines left out as %s", cfg.source_name, row.n, row.kind)
    return sheet.rows
