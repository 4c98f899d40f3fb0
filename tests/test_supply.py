from __future__ import annotations

from datetime import date, datetime

import pytest

from stockflow.operators.distributor import (
    SheetConfig,
    append_sources,
    normalize_distributor,
    sheet_inventory,
    sheet_rows,
    title_lines,
    unmapped,
)
from stockflow.plans import supply, transition

from .helpers import bag, one

BUYLIST = "Company string, BuyListCode string, ItemCode string, StateReferenceNumber string, BuylistItemStatus string, CustomerCrossReference string, Customer string, CustomerDeliveryAddressCode string, CustomerFullName string, BuyListDetailKey string, TransitionSKU string"


def entry(item, ref, status, xref, customer="123", address="001", company="SA", bl="L1", successor=None):
    return (company, bl, item, ref, status, xref, customer, address, "Full", "k", successor)


@pytest.fixture
def buylist(spark):
    return spark.createDataFrame(
        [
            entry("P1", "00123", "1", "X1"),
            entry("P2", "00123", "2", "X1"),  # same reference, worse status
            entry("P3", "555", "1", None),
            entry("P4", "556", "1", None),  # null reference collapses with P3
            entry("P5", "777", None, "X5"),  # null status ranks first
            entry("P6", "777", "1", "X5"),
            entry("P7", "888", "1", "X7", address=None),
            entry("P8", "00123", "3", "X8"),  # other reference, same key as P1
            entry("P9", "999", "1", "X9", company="SI"),
        ],
        BUYLIST,
    )


def test_crosswalk(buylist):
    got = supply.crosswalk(buylist)
    assert got.columns == list(supply.CROSSWALK_COLUMNS)
    assert bag(got, "CATN32", "BLCD32", "CSRF32", "Key3") == {
        ("P1", "123 001", "X1", "123 00100123"): 1,
        ("P3", "123 001", None, "123 001555"): 1,
        ("P5", "123 001", "X5", "123 001777"): 1,
        ("P7", "123", "X7", "123888"): 1,
    }


def test_crosswalk_switches(buylist):
    by_state = supply.crosswalk(buylist, rank_by="state_reference")
    assert {r.CATN32 for r in by_state.collect()} == {"P1", "P3", "P4", "P5", "P7"}
    both = supply.crosswalk(buylist, companies=("SA", "SI"))
    assert "P9" in {r.CATN32 for r in both.collect()}


ORDERS = "CustomerNumber string, DeliveryAddressCode string, SKU string, OrderNumber string, OrderQty double, FulfillLineShippedQTY double, RequestedShipDate timestamp_ntz, LineStatusCode string, HeaderTypeCode string"
ASOF = date(2024, 1, 5)


def order(number, when, sku="P1", status="OPEN", kind="STD", customer="123", address="001", shipped=1.0):
    return (customer, address, sku, number, 2.0, shipped, when, status, kind)


def test_in_transit(spark, buylist):
    day = datetime(2024, 1, 5)
    rows = [
        order("edge today", day),
        order("edge first", datetime(2024, 1, 2)),
        order("with time", datetime(2024, 1, 5, 10)),
        order("too old", datetime(2024, 1, 1, 23)),
        order("no date", None),
        order("same day", datetime(2024, 1, 4)), order("same day", datetime(2024, 1, 4, 9)),
        order("cancelled", day, status="CANCELED"), order("no status", day, status=None),
        order("XPALLETX", day), order("pallet sku", day, sku="PALLETSLIPCHG"), order("no sku", day, sku=None),
        order("no list", day, sku="P99"),
        order("no address", day, address=None),
    ]
    kinds = ("BAILMENT - RETURN ORDER", "BILLING ORDER", "DESTRUCTION ORDER", "INTERCOMPANY ORDER", "RETURN ORDER", None)
    rows += [order(f"kind {k}", day, kind=k) for k in kinds]
    orders = spark.createDataFrame(rows, ORDERS)
    got = supply.in_transit(orders, supply.crosswalk(buylist), ASOF)
    assert got.columns == ["CUSTOMER", "ORDN55", "CASES_ORD", "CASES_STP", "CATN55", "CSRQ40", "CSRF32", "SIRF32", "Data Source", "Key", "PO Status 2"]
    assert bag(got, "ORDN55", "CUSTOMER", "CSRF32", "Key") == {
        ("edge today", "123 001", "X1", "123 001X1"): 1,
        ("edge first", "123 001", "X1", "123 001X1"): 1,
        ("same day", "123 001", "X1", "123 001X1"): 1,
        ("no list", "123 001", None, None): 1,
        ("no address", "123 ", None, None): 1,
    }
    assert bag(got, "Data Source", "PO Status 2") == {("Oracle", "In Transit"): 5}
    wide = supply.in_transit(orders, supply.crosswalk(buylist), ASOF, days=10, excluded_types=())
    assert {"too old", "kind RETURN ORDER"} <= {r.ORDN55 for r in wide.collect()}


SHEET = SheetConfig(location="report_title", item="column4", on_hand="column11")


@pytest.fixture
def sheet(spark):
    return spark.createDataFrame(
        [
            ("Report", None, None), ("Site", "Item", "On Hand"), (None, None, "12"),
            ("ABQ", "00A", "3"), (" ATL ", "B", "4.5"), ("DAL", "C", "1"), ("DAL", "D", "1"), (None, "E", "0"),
        ],
        "report_title string, column4 string, column11 string",
    )


def test_distributor_sheet(sheet):
    assert bag(normalize_distributor(sheet, SHEET)) == {
        ("00A", "1056497 001", 3.0): 1, ("B", "1056527 001", 4.5): 1, ("C", None, 1.0): 1,
        ("D", None, 1.0): 1, ("E", None, 0.0): 1,
    }
    assert bag(unmapped(sheet, SHEET)) == {("DAL", 2): 1, (None, 1): 1}


def test_sheet_rejects(spark, sheet):
    """Every row is kept, rejected with a reason, or counted as a title line."""
    more = spark.createDataFrame([("ABQ", "F", "1,234"), ("ABQ", None, None), (" ATL", None, "x"), ("DAL", "G", "2,5")], sheet.schema)
    rows = sheet.union(more)
    kept, rejected = sheet_rows(rows, SHEET)
    assert bag(rejected, "column4", "column11", "reason") == {
        (None, "12", "NO_ITEM"): 1, ("F", "1,234", "BAD_QUANTITY"): 1, (None, None, "BAD_QUANTITY"): 1,
        (None, "x", "BAD_QUANTITY"): 1, ("G", "2,5", "BAD_QUANTITY"): 1,
    }
    assert kept.count() + rejected.count() + title_lines(rows, SHEET).first().n_titles == rows.count()
    usable, lost = sheet_inventory(rows, SHEET)
    assert bag(usable, "location", "item", "on_hand_qty") == {("1056497 001", "00A", 3): 1, ("1056527 001", "B", 5): 1}
    assert bag(lost.where("reason LIKE '%LOCATION'"), "column4", "reason") == {
        ("C", "UNMAPPED_LOCATION"): 1, ("D", "UNMAPPED_LOCATION"): 1, ("E", "NO_LOCATION"): 1,
    }


def test_append_sources(spark):
    a = spark.createDataFrame([("l", "i", 1, 2, "x")], "location string, item string, on_hand_qty long, in_transit_qty long, extra string")
    b = spark.createDataFrame([("m", "j", 3)], "location string, item string, on_hand_qty long")
    got = append_sources({"a": a, "b": b})
    assert got.columns == ["source", "location", "item", "on_hand_qty", "in_transit_qty"]
    assert bag(got) == {("a", "l", "i", 1, 2): 1, ("b", "m", "j", 3, None): 1}
    with pytest.raises(ValueError, match="on_hand_qty"):
        append_sources({"b": b.drop("on_hand_qty")})


@pytest.fixture
def inventory(spark):
    return spark.createDataFrame(
        [("123 001", "00123", 5, 1), ("123 001", "00123", 6, None), ("123 001", "123", 7, 2), (None, None, 8, 3), ("123 001", "777", 9, 4)],
        "location string, item string, on_hand_qty long, in_transit_qty long",
    )


def test_upload_accounts_for_every_row(buylist, inventory):
    up = supply.build_upload(inventory, supply.crosswalk(buylist), fifth=("Max Order", 0))
    assert bag(up.rows) == {
        ("P1", "123 001", 5, 1.0, 0): 1, ("P1", "123 001", 6, 0.0, 0): 1, ("P5", "123 001", 9, 4.0, 0): 1,
    }
    assert bag(up.quarantine, "location", "item", "reason") == {
        ("123 001", "123", "NO_SKU_MATCH"): 1, (None, None, "NO_LOCATION"): 1,
    }
    assert bag(supply.quarantine_by_reason(up.quarantine)) == {("NO_SKU_MATCH", 1): 1, ("NO_LOCATION", 1): 1}
    assert up.rows.count() + up.quarantine.count() == inventory.count()
    rate = one(up.match_rate)
    assert (rate.n_rows, rate.n_matched, rate.status) == (5, 3, "FAIL")
    assert bag(supply.unmatched_report(up.quarantine)) == {("123 001", "123", "NO_SKU_MATCH", 1): 1, (None, None, "NO_LOCATION", 1): 1}
    assert rate.reasons == "NO_LOCATION=1,NO_SKU_MATCH=1"


def test_the_gate_counts_what_is_published(spark):
    """Rows that meet a product but have no ship-to are no matches."""
    joined = spark.createDataFrame([(None, "i", "P"), (None, "j", "P")], "location string, item string, CATN32 string")
    rate = one(supply.publish_rate(joined))
    assert (rate.n_rows, rate.n_matched, rate.match_rate, rate.status, rate.reasons) == (2, 0, 0.0, "FAIL", "NO_LOCATION=2")
    good = spark.createDataFrame([("l", "i", "P")], joined.schema)
    assert one(supply.publish_rate(good)).status == "PASS"
    assert one(supply.publish_rate(good, min_rows=2)).status == "FAIL"
    empty = one(supply.publish_rate(good.limit(0)))
    assert (empty.n_rows, empty.match_rate, empty.status, empty.reasons) == (0, None, "FAIL", "")


def test_upload_with_orders_in_transit(spark, buylist, inventory):
    day = datetime(2024, 1, 5)
    orders = spark.createDataFrame([order("a", day), order("b", day, shipped=None)], ORDERS)
    xwalk = supply.crosswalk(buylist)
    transit = supply.in_transit(orders, xwalk, ASOF)
    ordered = supply.build_upload(inventory, xwalk, transit).rows
    assert bag(ordered, "Product", "In Transit") == {("P1", 4.0): 2, ("P5", 0.0): 1}
    shipped = supply.build_upload(inventory, xwalk, transit, qty="shipped").rows
    assert bag(shipped, "Product", "In Transit") == {("P1", 1.0): 2, ("P5", 0.0): 1}


def test_transition(spark):
    bl = spark.createDataFrame(
        [
            entry("P1", "r", "1", "x", bl="L1", successor="P2"), entry("P1", "r", "1", "x", bl="L1", customer="9", successor="P2"),
            entry("P2", "r", "1", "x", bl="L1"), entry("P1", "r", "1", "x", bl="L2", successor="P2"), entry("P3", "r", "1", "x", bl="L2"),
        ],
        BUYLIST,
    )
    assert bag(transition.transition_gap(bl), "BuyListCode", "ItemCode", "TransitionSKU") == {("L2", "P1", "P2"): 1}
    assert bag(transition.transition_items(bl)) == {("P1", "P2"): 1}
    orders = spark.createDataFrame([("P1", None), ("P1", "2024"), ("P2", None)], "SKU string, ShipDate string")
    assert bag(transition.transition_open_orders(orders, bl)) == {("P1", None): 1}


def test_rank_rules_compared(buylist):
    # P4's SKU exists only when ranked by state reference.
    assert bag(supply.rank_rule_difference(buylist)) == {("SAME", 4, 4, 4): 1, ("ONLY_A", 1, 1, 0): 1}
