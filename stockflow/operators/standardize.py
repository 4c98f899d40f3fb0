"""Raw file columns to staged columns. The order of the steps is part of the contract:
rename, text, strip, quantities, zero fill, source-specific step, de-duplication."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.config import RunContext, SourceConfig
from stockflow.functions.numbers import to_quantity
from stockflow.functions.text import strip_ws
from stockflow.operators.keyed import Split, last_by, repeats
from stockflow.sources.files import ORDINAL, ROW_ID, TECHNICAL

log = logging.getLogger(__name__)


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename by map; names the frame does not have are ignored."""
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def _present(df: DataFrame, columns: Sequence[str], kind: str) -> list[str]:
    for c in columns:
        if c not in df.columns:
            log.warning("%s column %s is not in the source", kind, c)
    return [c for c in columns if c in df.columns]


def force_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to string; nulls stay null, so they cannot become key values."""
    return df.withColumns({c: F.col(c).cast("string") for c in _present(df, columns, "text")})


def strip_text(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    text = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in TECHNICAL
    ]
    return df.withColumns({c: strip_ws(F.col(c)) for c in text})


def quantities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whole units, rounded up, with zero for what is missing or not a number."""
    found = _present(df, columns, "quantity")
    return df.withColumns({c: F.coalesce(to_quantity(F.col(c)), F.lit(0)) for c in found})


def split_embedded_headers(df: DataFrame, key: str, literals: Sequence[str]) -> Split:
    """Take out rows whose key repeats the header; a null key is no header."""
    is_header = F.coalesce(F.col(key).isin(*literals), F.lit(False))
    return Split(
        df.where(~is_header), df.where(is_header).withColumn("reason", F.lit("EMBEDDED_HEADER"))
    )


def clean(df: DataFrame, cfg: SourceConfig, row_id: str = ROW_ID) -> Split:
    """All row-wise steps, up to but not including de-duplication."""
    df = rename_columns(df, cfg.renames)
    df = force_text(df, cfg.text_columns)
    df = strip_text(df)
    df = quantities(df, cfg.quantity_columns)
    rejected = df.where(F.lit(False)).withColumn("reason", F.lit(""))
    if cfg.header_key:
        df, rejected = split_embedded_headers(df, cfg.header_key, cfg.header_literals)
    if cfg.custom:
        df, dropped = custom_step(df, cfg.custom, row_id)
        rejected = rejected.unionByName(dropped, allowMissingColumns=True)
    return Split(df, rejected)


def custom_step(
    df: DataFrame, custom: Callable[[DataFrame], DataFrame | Split], row_id: str
) -> Split:
    """Run a source's own step. What it drops is rejected as CUSTOM_STEP, found by ``row_id``,
    unless the step returns a ``Split`` and names its rejects itself."""
    result = custom(df)
    if isinstance(result, Split):
        return result
    if row_id not in df.columns:
        return Split(result, df.where(F.lit(False)).withColumn("reason", F.lit("")))
    dropped = df.join(result.select(row_id), row_id, "left_anti")
    return Split(result, dropped.withColumn("reason", F.lit("CUSTOM_STEP")))


def standardize(
    df: DataFrame,
    cfg: SourceConfig,
    order: Sequence[str] = ORDINAL,
    row_id: str = ROW_ID,
) -> Split:
    """Staged rows, and every row taken out on the way with its reason.

    ``order`` is the file order and ``row_id`` a unique column; both come from
    ``read_source`` and stay on the result until it is written. A source-specific
    step must keep ``row_id`` unique.
    """
    cleaned, headers = clean(df, cfg, row_id)
    kept = deduplicate(cleaned, cfg, order)
    return Split(kept, rejects(cleaned, headers, kept, cfg, row_id))


def deduplicate(
    cleaned: DataFrame, cfg: SourceConfig, order: Sequence[str] = ORDINAL
) -> DataFrame:
    if not cfg.business_key:
        log.warning("%s has no business key; de-duplication skipped", cfg.source_name)
        return cleaned
    return last_by(cleaned, cfg.business_key, order)


def rejects(
    cleaned: DataFrame,
    headers: DataFrame,
    kept: DataFrame,
    cfg: SourceConfig,
    row_id: str = ROW_ID,
) -> DataFrame:
    """Header lines and repeats; ``kept`` may be the stored result of ``deduplicate``."""
    if not cfg.business_key:
        return headers
    return headers.unionByName(repeats(cleaned, kept, row_id), allowMissingColumns=True)


def with_audit(df: DataFrame, ctx: RunContext) -> DataFrame:
    """The four audit columns every governed table carries."""
    return df.withColumns(
        {
            "load_date": F.lit(ctx.load_date),
            "load_timestamp": F.lit(ctx.load_timestamp),
            "src_file_name": F.lit(ctx.src_file_name),
            "pipeline_run_id": F.lit(ctx.run_id),
        }
    )
