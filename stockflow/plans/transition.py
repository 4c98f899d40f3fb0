"""Items that are being replaced: which lists lack the successor, which orders are open.

Only the names of these analyses are published. The rules here are our own: an
item is in transition when it names a transition SKU, and a list has the gap
when it carries the item but not that SKU.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.plans.erp import Tables, open_orders, orders_base


def transition_items(buylist: DataFrame) -> DataFrame:
    """Distinct items in transition with their successor."""
    return (
        buylist.where(F.col("TransitionSKU").isNotNull())
        .select("ItemCode", "TransitionSKU")
        .distinct()
    )


def transition_gap(buylist: DataFrame) -> DataFrame:
    """Company, list and item in transition where the list lacks the successor."""
    entries = buylist.select("Company", "BuyListCode", "ItemCode", "TransitionSKU").distinct()
    carried = entries.select(
        F.col("Company").alias("__company"),
        F.col("BuyListCode").alias("__list"),
        F.col("ItemCode").alias("__item"),
    )
    match = [
        F.col("Company") == F.col("__company"),
        F.col("BuyListCode") == F.col("__list"),
        F.col("TransitionSKU") == F.col("__item"),
    ]
    return entries.where(F.col("TransitionSKU").isNotNull()).join(carried, match, "left_anti")


def transition_open_orders(orders: DataFrame, buylist: DataFrame) -> DataFrame:
    """Open order lines for items in transition."""
    items = transition_items(buylist).select(F.col("ItemCode").alias("__item"))
    return open_orders(orders).join(items, F.col("SKU") == F.col("__item"), "left_semi")


def open_orders_in_transition(orders: Tables, buylist: DataFrame) -> DataFrame:
    """``transition_open_orders`` of the orders view, from its tables.

    An order line has its SKU from the item table, and lines without one are no
    open orders: with the items in transition alone all other lines go at the first
    lookup, before they meet fulfil lines and headers.
    """
    items = transition_items(buylist).select(F.col("ItemCode").alias("__item"))
    named = orders["item"].join(items, F.col("ITEMBASEPEOITEMNUMBER") == F.col("__item"), "left_semi")
    return open_orders(orders_base({**orders, "item": named}))
