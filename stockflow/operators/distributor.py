"""Distributor sheets: location codes to customer codes, and sources appended to one frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.config import DISTRIBUTOR_LOCATIONS, INVENTORY_OPTIONAL, INVENTORY_REQUIRED
from stockflow.functions.numbers import to_number, to_quantity
from stockflow.functions.text import strip_ws
from stockflow.operators.joins import lookup
from stockflow.operators.keyed import Split

ITEM_REFERENCE = "Customer Item Reference"
CUSTOMER_KEY = "Dpl Customer (key)"
ON_HAND = "On Hand Loaded"


@dataclass(frozen=True)
class SheetConfig:
    """Columns of a distributor sheet, by name, and its location map."""

    location: str
    item: str
    on_hand: str
    locations: Mapping[str, str] = field(default_factory=lambda: DISTRIBUTOR_LOCATIONS)


def map_codes(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace a code by its mapped value; anything else becomes null."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def sheet_rows(df: DataFrame, cfg: SheetConfig) -> Split:
    """Data rows of a sheet, and rows that should be data but are not, with a ``reason``.

    Title lines above the data are recognised by content, not by their position:
    they have no numeric quantity and neither an item nor a known location, or
    repeat the column names. They are neither kept nor rejected;
    ``title_lines`` counts them. A row with an item or a known location but
    without a numeric quantity is rejected as BAD_QUANTITY, one with a quantity
    but without an item as NO_ITEM.
    """
    has_item = F.col(cfg.item).isNotNull()
    number = to_number(F.col(cfg.on_hand)).isNotNull()
    reason = F.when(~_is_title(cfg) & ~number, "BAD_QUANTITY").when(number & ~has_item, "NO_ITEM")
    rejected = df.withColumn("reason", reason).where(F.col("reason").isNotNull())
    return Split(df.where(has_item & number), rejected)


def _is_title(cfg: SheetConfig) -> Column:
    location = strip_ws(F.col(cfg.location))
    known = F.coalesce(map_codes(location, cfg.locations).isNotNull(), F.lit(False))
    number = to_number(F.col(cfg.on_hand)).isNotNull()
    # A line of column names has text where the quantity should be, without any digit.
    named = F.coalesce(~F.col(cfg.on_hand).rlike(r"\d"), F.lit(True)) & ~known
    return ~number & ~known & (F.col(cfg.item).isNull() | named)


def title_lines(df: DataFrame, cfg: SheetConfig) -> DataFrame:
    """Number of title lines, as one row."""
    return df.agg(F.count_if(_is_title(cfg)).alias("n_titles"))


def normalize_distributor(df: DataFrame, cfg: SheetConfig) -> DataFrame:
    """Item reference, customer key and on-hand quantity of a sheet.

    Rows of an unmapped location keep a null customer key; ``unmapped`` reports them.
    """
    location = strip_ws(F.col(cfg.location))
    return sheet_rows(df, cfg).kept.select(
        F.col(cfg.item).alias(ITEM_REFERENCE),
        map_codes(location, cfg.locations).alias(CUSTOMER_KEY),
        to_number(F.col(cfg.on_hand)).alias(ON_HAND),
    )


def unmapped(df: DataFrame, cfg: SheetConfig) -> DataFrame:
    """Location codes of data rows that have no customer code, with their row counts."""
    location = strip_ws(F.col(cfg.location))
    rows = sheet_rows(df, cfg).kept.select(
        location.alias("location"), map_codes(location, cfg.locations).alias("code")
    )
    return (
        rows.where(F.col("code").isNull()).groupBy("location").agg(F.count(F.lit(1)).alias("n_rows"))
    )


def sheet_inventory(df: DataFrame, cfg: SheetConfig) -> Split:
    """A sheet under the standard inventory names, and every data row that cannot be used.

    Rejects are those of ``sheet_rows`` and rows whose location has no customer
    code (UNMAPPED_LOCATION) or that have no location (NO_LOCATION).
    """
    kept, rejected = sheet_rows(df, cfg)
    location = strip_ws(F.col(cfg.location))
    code = map_codes(location, cfg.locations)
    reason = F.when(code.isNotNull(), None).when(location.isNull(), "NO_LOCATION")
    lost = kept.withColumn("reason", reason.otherwise("UNMAPPED_LOCATION")).where(code.isNull())
    usable = kept.where(code.isNotNull()).select(
        code.alias("location"),
        F.col(cfg.item).alias("item"),
        to_quantity(F.col(cfg.on_hand)).alias("on_hand_qty"),
    )
    return Split(usable, rejected.unionByName(lost))


def sheet_step(
    locations: DataFrame, location: str = "location", item: str = "item", on_hand: str = "on_hand_qty"
) -> Callable[[DataFrame], Split]:
    """A source's own step for sheets: usable rows with customer code and whole units, the rest as rejects.

    ``locations`` is a table of ``code`` and ``customer``; of repeated codes the
    smallest customer holds. Reasons: NO_ITEM, BAD_QUANTITY, NO_LOCATION,
    UNMAPPED_LOCATION. What the sheet reported stays in two columns of its own.
    The quantity must not be among the source's quantity columns, which turn what
    is not a number into zero.
    """
    codes = locations.where("customer IS NOT NULL").groupBy(strip_ws(F.col("code")).alias("__code")).agg(F.min("customer").alias("__customer"))

    def step(rows: DataFrame) -> Split:
        rows = rows.withColumns({"reported_location": F.col(location), "reported_on_hand": F.col(on_hand)})
        found = lookup(rows, codes, [(location, "__code")]).withColumn(on_hand, to_quantity(F.col(on_hand)))
        reason = (
            F.when(F.col(item).isNull(), "NO_ITEM")
            .when(F.col(on_hand).isNull(), "BAD_QUANTITY")
            .when(F.col(location).isNull(), "NO_LOCATION")
            .when(F.col("__customer").isNull(), "UNMAPPED_LOCATION")
        )
        judged = found.withColumn("reason", reason).withColumn(location, F.col("__customer")).drop("__code", "__customer")
        return Split(judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL"))

    return step


def append_sources(
    frames: Mapping[str, DataFrame],
    required: Sequence[str] = INVENTORY_REQUIRED,
    optional: Sequence[str] = INVENTORY_OPTIONAL,
) -> DataFrame:
    """All sources of a domain under the standard names, with a ``source`` label.

    An optional column a source lacks is null; a required one is an error.
    """
    parts = []
    for name, df in frames.items():
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"source {name} lacks {missing}")
        found = [c for c in (*required, *optional) if c in df.columns]
        parts.append(df.select(F.lit(name).alias("source"), *found))
    appended = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return appended.select("source", *(c for c in (*required, *optional) if c in appended.columns))
