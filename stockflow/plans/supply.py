"""SKU crosswalk, orders in transit, and the upload assembled from both."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.config import (
    CANCELED_LINE_STATUS,
    DEFAULT_COMPANIES,
    EXCLUDED_ORDER_TYPES,
    PALLET_FRAGMENT,
)
from stockflow.functions.text import amp_concat, sql_concat, text_combine
from stockflow.operators.joins import lookup, reconcile
from stockflow.operators.keyed import first_by, first_match

# Buying-list columns the crosswalk reads.
CROSSWALK_INPUT = (
    "Company", "BuyListCode", "ItemCode", "StateReferenceNumber", "BuylistItemStatus",
    "CustomerCrossReference", "Customer", "CustomerDeliveryAddressCode", "CustomerFullName",
    "BuyListDetailKey",
)
CROSSWALK_COLUMNS = (
    "Company", "BuyListCode", "CATN32", "StateReferenceNumber", "BuylistItemStatus", "CSRF32",
    "Customer", "CustomerDeliveryAddressCode", "CustomerFullName", "BuyListDetailKey", "BLCD32",
    "Key3",
)
IN_TRANSIT_KEY = ("CUSTOMER", "ORDN55", "CASES_ORD", "CASES_STP", "CATN55", "CSRQ40")
UPLOAD_COLUMNS = ("Product", "CompanyCode-Ship", "On Hand", "In Transit")


def filter_company(df: DataFrame, codes: Sequence[str] = DEFAULT_COMPANIES) -> DataFrame:
    return df.where(F.col("Company").isin(*codes))


def _best_first(columns: Sequence[str]):
    """Lowest status first; the other columns only settle ties."""
    rest = [c for c in columns if c != "BuylistItemStatus"]
    return [F.col(c).asc_nulls_first() for c in ("BuylistItemStatus", *rest)]


def ranked_crosswalk(
    buylist: DataFrame,
    companies: Sequence[str] = DEFAULT_COMPANIES,
    rank_by: str = "cross_reference",
) -> DataFrame:
    """Best buying-list row per customer, address and reference.

    ``rank_by="cross_reference"`` is the rule in use. It keeps one distributor
    SKU for all rows that share a cross reference, null included;
    ``"state_reference"`` ranks within the SKU the key is built from.
    """
    reference = {
        "cross_reference": "CustomerCrossReference",
        "state_reference": "StateReferenceNumber",
    }[rank_by]
    rows = filter_company(buylist, companies).select(*CROSSWALK_INPUT)
    keys = (reference, "Customer", "CustomerDeliveryAddressCode")
    return first_by(rows, keys, _best_first(CROSSWALK_INPUT))


def crosswalk(
    buylist: DataFrame,
    companies: Sequence[str] = DEFAULT_COMPANIES,
    rank_by: str = "cross_reference",
) -> DataFrame:
    """One row per ``Key3`` = customer code + distributor SKU, with the product code ``CATN32``."""
    customer_code = text_combine(
        " ", F.col("Customer"), F.col("CustomerDeliveryAddressCode")
    )
    keyed = (
        ranked_crosswalk(buylist, companies, rank_by)
        .withColumn("Key3", text_combine("", customer_code, F.col("StateReferenceNumber")))
        .withColumnsRenamed({"ItemCode": "CATN32", "CustomerCrossReference": "CSRF32"})
    )
    # The code says no more than customer and address, so it settles no tie and need not travel.
    settled = [c for c in CROSSWALK_COLUMNS if c not in ("BLCD32", "Key3")]
    best = first_by(keyed.select(*settled, "Key3"), ["Key3"], _best_first(settled))
    return best.withColumn("BLCD32", customer_code).select(*CROSSWALK_COLUMNS)


def rank_rule_difference(
    buylist: DataFrame, companies: Sequence[str] = DEFAULT_COMPANIES
) -> DataFrame:
    """Keys the two rank rules produce: ``ONLY_A`` are distributor SKUs that ranking by cross
    reference loses. Key counts are the row counts, since a key is unique in each."""
    by_state = crosswalk(buylist, companies, "state_reference")
    by_cross = crosswalk(buylist, companies, "cross_reference")
    return reconcile(by_state, by_cross, ["Key3"])


def shippable_lines(
    orders: DataFrame,
    asof: date,
    days: int = 3,
    excluded_types: Sequence[str] = EXCLUDED_ORDER_TYPES,
    excluded_fragment: str = PALLET_FRAGMENT,
) -> DataFrame:
    """Order lines requested in ``asof - days`` to ``asof``, without cancelled lines, pallet
    charges and excluded order types. A null in any tested column drops the line.

    The ship date is compared as it is: with a time of day, only midnight of
    ``asof`` itself is inside.
    """
    return orders.where(
        (F.col("LineStatusCode") != CANCELED_LINE_STATUS)
        & ~F.col("OrderNumber").contains(excluded_fragment)
        & ~F.col("SKU").contains(excluded_fragment)
        & ~F.col("HeaderTypeCode").isin(*excluded_types)
        & F.col("RequestedShipDate").between(F.date_sub(F.lit(asof), days), F.lit(asof))
    )


def in_transit(
    orders: DataFrame, xwalk: DataFrame, asof: date, days: int = 3, **filters
) -> DataFrame:
    """Recent order lines with the customer's reference, one row per order key.

    Distinct is applied once and before the lookup: the lookup brings at most
    one reference per row, so nothing can repeat afterwards.
    """
    lines = shippable_lines(orders, asof, days, **filters).select(
        sql_concat(F.col("CustomerNumber"), F.lit(" "), F.col("DeliveryAddressCode")).alias(
            "CUSTOMER"
        ),
        F.col("OrderNumber").alias("ORDN55"),
        F.col("OrderQty").alias("CASES_ORD"),
        F.col("FulfillLineShippedQTY").alias("CASES_STP"),
        F.col("SKU").alias("CATN55"),
        F.col("RequestedShipDate").cast("date").alias("CSRQ40"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("BuylistItemStatus", "CSRF32", "Key3")]
    found = first_match(
        lines.distinct(), xwalk, [("CUSTOMER", "BLCD32"), ("CATN55", "CATN32")], order, ["CSRF32"]
    )
    return found.select(
        *IN_TRANSIT_KEY,
        "CSRF32",
        F.col("CSRF32").alias("SIRF32"),
        F.lit("Oracle").alias("Data Source"),
        amp_concat(F.col("CUSTOMER"), F.col("CSRF32")).alias("Key"),
        F.lit("In Transit").alias("PO Status 2"),
    )


def crosswalk_join(inventory: DataFrame, xwalk: DataFrame) -> DataFrame:
    """Inventory with ``Key2``, product code and reference; no match gives nulls.

    ``inventory`` has ``location`` (customer code) and ``item`` (distributor
    SKU). ``Key3`` is unique, so rows are never multiplied.
    """
    keyed = inventory.withColumn("Key2", text_combine("", F.col("location"), F.col("item")))
    codes = xwalk.select(F.col("Key3").alias("__key3"), "CATN32", "CSRF32")
    return lookup(keyed, codes, [("Key2", "__key3")]).drop("__key3")


class Resolved(NamedTuple):
    matched: DataFrame
    unmatched: DataFrame


def resolve_sku(inventory: DataFrame, xwalk: DataFrame) -> Resolved:
    """Split inventory by whether the crosswalk knows the SKU; nothing is dropped unseen."""
    return split_resolved(crosswalk_join(inventory, xwalk))


def quarantine_reason() -> Column:
    """Why a row of ``crosswalk_join`` cannot be published, or null.

    The key rule skips a null part, so that a row without a location may meet a
    crosswalk entry without a customer; such a row has no ship-to and is not used.
    """
    return (
        F.when(F.col("location").isNull(), "NO_LOCATION")
        .when(F.col("item").isNull(), "NO_ITEM")
        .when(F.col("CATN32").isNull(), "NO_SKU_MATCH")
    )


def split_resolved(joined: DataFrame) -> Resolved:
    """Usable rows, and all others with their reason."""
    reason = quarantine_reason()
    unmatched = joined.withColumn("reason", reason).where(F.col("reason").isNotNull())
    return Resolved(joined.where(reason.isNull()), unmatched)


def quarantine_by_reason(unmatched: DataFrame) -> DataFrame:
    return unmatched.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def unmatched_report(unmatched: DataFrame) -> DataFrame:
    """Customer code and distributor SKU of quarantined rows by reason, with row counts."""
    return unmatched.groupBy("location", "item", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def publish_rate(joined: DataFrame, threshold: float = 0.8, min_rows: int = 1) -> DataFrame:
    """The gate of the upload, as one row: what is published of all rows of ``crosswalk_join``.

    A row counts as matched if nothing quarantines it, so a source whose rows meet
    a product but have no ship-to does not pass. It fails below the share or with
    fewer than ``min_rows`` publishable rows; ``reasons`` counts the others.
    """
    reason = quarantine_reason()
    per = joined.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    out = F.when(F.col("reason").isNotNull(), F.concat_ws("=", "reason", F.col("n").cast("string")))
    one = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("n_matched"),
        F.concat_ws(",", F.array_sort(F.collect_list(out))).alias("reasons"),
    )
    rate = F.when(F.col("n_rows") > 0, F.col("n_matched") / F.col("n_rows"))
    passed = (rate >= threshold) & (F.col("n_matched") >= min_rows)
    return one.select(
        "n_rows",
        "n_matched",
        F.round(rate, 6).alias("match_rate"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        "reasons",
    )


class Upload(NamedTuple):
    """Upload rows, quarantined rows, and the match-rate row to gate on."""

    rows: DataFrame
    quarantine: DataFrame
    match_rate: DataFrame


# In-transit quantity the upload takes: what was ordered or what was shipped.
QUANTITY = {"ordered": "CASES_ORD", "shipped": "CASES_STP"}


def upload_rows(
    matched: DataFrame,
    transit: DataFrame | None = None,
    qty: str = "ordered",
    fifth: tuple[str, object] | None = None,
) -> DataFrame:
    """Upload columns of matched inventory.

    In Transit is the source's own quantity. With ``transit`` it is the summed
    order quantity of the customer and reference instead, added up per key
    before the join; every inventory row of that key shows the sum. ``fifth``
    names the column whose meaning is not settled, with a constant to fill it.
    """
    own = F.coalesce("in_transit_qty", F.lit(0)) if "in_transit_qty" in matched.columns else F.lit(0)
    amount = own.cast("double")
    if transit is not None:
        moving = (
            transit.where(F.col("Key").isNotNull())
            .groupBy(F.col("Key").alias("__key"))
            .agg(F.sum(QUANTITY[qty]).alias("__moving"))
        )
        matched = lookup(
            matched.withColumn("__ref", amp_concat(F.col("location"), F.col("CSRF32"))),
            moving,
            [("__ref", "__key")],
            spread_by=["Key2", "on_hand_qty"],
        )
        amount = F.coalesce("__moving", F.lit(0.0))
    columns = [
        F.col("CATN32").alias("Product"),
        F.col("location").alias("CompanyCode-Ship"),
        F.col("on_hand_qty").alias("On Hand"),
        amount.alias("In Transit"),
    ]
    if fifth:
        columns.append(F.lit(fifth[1]).alias(fifth[0]))
    return matched.select(*columns)


def build_upload(
    inventory: DataFrame,
    xwalk: DataFrame,
    transit: DataFrame | None = None,
    qty: str = "ordered",
    fifth: tuple[str, object] | None = None,
    threshold: float = 0.8,
) -> Upload:
    """Appended inventory to upload rows, with the unmatched rows and the match rate.

    Each of the three is an action of its own over the same join;
    ``publish_upload`` stores the join first.
    """
    joined = crosswalk_join(inventory, xwalk)
    resolved = split_resolved(joined)
    return Upload(
        upload_rows(resolved.matched, transit, qty, fifth),
        resolved.unmatched,
        publish_rate(joined, threshold),
    )
