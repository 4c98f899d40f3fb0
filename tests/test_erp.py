"""The two views on hand-made tables with every edge the joins have."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stockflow.config import RunContext
from stockflow.plans import erp

from .helpers import bag, one


def frame(spark, columns: str, *rows):
    return spark.createDataFrame(list(rows), columns)


def padded(spark, columns, types, rows):
    """Rows given as dicts; columns not named are null strings."""
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


@pytest.fixture
def buylist(spark):
    item_cols = [*erp.BUYLIST_ITEM_COLUMNS.values(), "BUYLISTKEY", "ITEMKEY"]
    keys = {"BUYLISTKEY": "long", "ITEMKEY": "long", "ItemKey": "long", "CUSTOMERKEY": "long", "CustomerKey": "long"}
    base = {"COMPANY_CODE": "SA", "BUYING_LIST_CODE": "L1"}
    return {
        "item": padded(spark, item_cols, keys, [
            {**base, "BUYLISTKEY": 1, "ITEMKEY": 10, "ITEM_CODE": "I10", "SHIP_POINT1": "W1"},
            {**base, "BUYLISTKEY": 1, "ITEMKEY": 99, "ITEM_CODE": "I99"},
            {**base, "BUYLISTKEY": 2, "ITEMKEY": None, "ITEM_CODE": "I20"},
            {**base, "BUYLISTKEY": 7, "ITEMKEY": 10, "ITEM_CODE": "orphan"},
            {**base, "BUYLISTKEY": None, "ITEMKEY": 10, "ITEM_CODE": "no list"},
        ]),
        "header": padded(spark, [*erp.BUYLIST_HEADER_COLUMNS.values(), "BUYLISTKEY"], keys,
                         [{"BUYLISTKEY": 1, "STATE": "KY"}, {"BUYLISTKEY": 2}]),
        "master": padded(spark, [*erp.ITEM_MASTER_COLUMNS.values(), "ItemKey"], keys,
                         [{"ItemKey": 10, "SKUDescription": "ten", "Subdivision/SupplierDescription": "sub"}]),
        "list_customer": padded(spark, [*erp.BUYLIST_CUSTOMER_COLUMNS.values(), "BUYLISTKEY", "CUSTOMERKEY"], keys, [
            {"BUYLISTKEY": 1, "CUSTOMERKEY": 5, "CUSTOMER": "C5", "DELIVERY_ADDRESS_CODE": "001"},
            {"BUYLISTKEY": 1, "CUSTOMERKEY": None, "CUSTOMER": "C6"},
        ]),
        "customer": padded(spark, [*erp.CUSTOMER_MASTER_COLUMNS.values(), "CustomerKey"], keys,
                           [{"CustomerKey": 5, "CustomerFullName": "Five"}]),
    }


def test_buylist_detail(buylist):
    view = erp.buylist_detail(buylist)
    assert view.columns == list(erp.BUYLIST_DETAIL_COLUMNS) and len(view.columns) == 62
    assert bag(view, "ItemCode", "State", "SKUDescription", "Subdivision/SupplierDescription", "Customer", "CustomerFullName", "BuyListDetailKey") == {
        ("I10", "KY", "ten", "sub", "C5", "Five", "I10C5SA001W1"): 1,
        ("I10", "KY", "ten", "sub", "C6", None, "I10C6SAW1"): 1,
        ("I99", "KY", None, None, "C5", "Five", "I99C5SA001"): 1,
        ("I99", "KY", None, None, "C6", None, "I99C6SA"): 1,
        ("I20", None, None, None, None, None, "I20SA"): 1,
    }


@pytest.fixture
def orders(spark):
    day = datetime(2024, 1, 5, 10)
    line = "LINEID long, LINEHEADERID long, LINEINVENTORYITEMID long, LINEINVENTORYORGANIZATIONID long, LINESOURCEORDERSYSTEM string, LINESOURCELINENUMBER string, LINEDISPLAYLINENUMBER string, LINEONHOLD string, LINECREATIONDATE timestamp, LINESCHEDULESHIPDATE timestamp, LINEACTUALSHIPDATE timestamp, LINESTATUSCODE string, LINEORDEREDQTY double, LINEORDEREDUOM string"
    tail = ("N", day, day, None, "OPEN", 3.0, "CS")
    header = "HEADERID long, HEADERSOLDTOPARTYID long, HEADERCUSTOMERPONUMBER string, HEADERORDERNUMBER string, HEADERONHOLD string, HEADERSTATUSCODE string, HEADERORDERTYPECODE string, HEADERSOURCEDOCUMENTTYPECODE string, HEADERORDEREDDATE timestamp, HEADERCREATIONDATE timestamp"

    def head(key, party, status, doc=None):
        return (key, party, "po", f"SO{key}", "N", status, "STD", doc, day, day)

    fulfill = "FULFILLLINEID long, FULFILLLINELINEID long, FULFILLLINEHEADERID long, FULFILLLINEINVENTORYORGANIZATIONID long, FULFILLLINEFULFILLORGID long, FULFILLLINESOURCEORDERNUMBER string, FULFILLLINESOURCELINENUMBER string, FULFILLLINESUBINVENTORY string, FULFILLLINELASTUPDATEDATE timestamp, FULFILLLINESHIPPEDQTY double"
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    return {
        "line": frame(spark, line,
            (11, 1, 100, 9, "SYS21", "s1", "d1", *tail),
            (12, 1, 101, 9, "ELSE", "s2", "d2", *tail),
            (13, 1, None, None, None, "s3", "d3", *tail),
            (21, 2, 100, 9, None, "s", "d", *tail),
            (31, 3, 100, 9, None, "s", "d", *tail),
            (41, 4, 100, 9, None, "s", "d", *tail),
            (51, 5, 100, 9, None, "s", "d", *tail)),
        "header": frame(spark, header, head(1, 50, "OPEN"), head(2, None, "CLOSED"), head(3, 50, "DOO_DRAFT"),
                        head(4, 50, None), head(5, 50, "OPEN", "REF")),
        "fulfill_line": frame(spark, fulfill,
            (1, 11, 1, 9, 70, "SO1", "1", "SUB1", old, 1.0),
            (2, 11, 1, 9, 70, "SO1", "1", "SUB1", new, 2.0),
            (3, 12, 1, 9, None, "SO1", "2", "SUB2", new, 5.0),
            (4, 12, 1, 9, 71, "SO1", "2", "SUB2", old, 9.0)),
        "address": frame(spark, "ORDERADDRESSHEADERID long, ORDERADDRESSPARTYSITEID long, ORDERADDRESSUSETYPE string",
            (1, 500, "SHIP_TO"), (1, 501, "BILL_TO"), (2, 500, "SHIP_TO"), (2, 502, "SHIP_TO")),
        "party_site": frame(spark, "PARTYSITEID long, PARTYSITENUMBER string", (500, "50-001-X"), (501, "50-999-X"), (502, "50-002")),
        "account": frame(spark, "PARTYID long, ACCOUNTNUMBER string, ACCOUNTNAME string", (50, "A50", "acc")),
        "party": frame(spark, "PARTYID long, PARTYNAME string", (50, "party")),
        "item": frame(spark, "ITEMBASEPEOINVENTORYITEMID long, ITEMBASEPEOINVENTORYORGANIZATIONID long, ITEMBASEPEOITEMNUMBER string, ITEMTRANSLATIONPEODESCRIPTION string, ITEMTRANSLATIONPEOLANGUAGE string",
            (100, 9, "SKU100", "us", "US"), (100, 9, "SKU100", "fr", "FR"), (101, 9, "PALLETSLIPCHG", "charge", "US")),
        "org": frame(spark, "ORGANIZATIONID long, ATTRIBUTE1 string, ORGANIZATIONCODE string", (70, "SA07", "W7"), (71, "SI08", "W8")),
        "org_unit": frame(spark, "ORGANIZATIONID long, ORGANIZATIONUNITTRANSLATIONPEONAME string", (70, "Unit 70")),
        "allocation": frame(spark, "FULFILL_LINE_ID long, CONTEXT_CODE string, ATTRIBUTE_CHAR1 string",
            (2, "Allocation Details", "SUBX"), (2, "Other", "SUBY"), (1, "Allocation Details", "SUBY")),
        "sub_inventory": frame(spark, "ORGANIZATION_ID long, SECONDARY_INVENTORY_NAME string, ATTRIBUTE1 string",
            (70, "SUBX", "SA33"), (70, "SUBY", "SA44")),
    }


def test_orders_base(orders):
    view = erp.orders_base(orders)
    assert view.columns == list(erp.ORDERS_BASE_COLUMNS) and len(view.columns) == 32
    got = bag(view, "OrderNumber", "LineNumber", "SKU", "SKUDesc", "FulfillLineShippedQTY", "Company", "Plant", "Stockroom", "OrganizationName", "DeliveryAddressCode", "CustomerNumber", "OrdersBaseKey")
    assert got == {
        # newest fulfil line, its allocation and stockroom; source line number for the own system
        ("SO1", "s1", "SKU100", "us", 2.0, "SA", "07", "33", "Unit 70", "001", "A50", "SKU100A50SA001W7"): 1,
        # charge line: fulfil line without organisation
        ("SO1", "d2", "PALLETSLIPCHG", "charge", 5.0, None, None, None, None, "001", "A50", "PALLETSLIPCHGA50001"): 1,
        # no item, no fulfil line
        ("SO1", "d3", None, None, None, None, None, None, None, "001", "A50", "A50001"): 1,
        # two ship-to addresses double the line; no account for a null party
        ("SO2", "d", "SKU100", "us", None, None, None, None, None, "001", None, "SKU100001"): 1,
        ("SO2", "d", "SKU100", "us", None, None, None, None, None, None, None, "SKU100"): 1,
    }
    assert bag(view, "HeaderCreateDate", "LineCreateDate") == {(datetime(2024, 1, 5).date(),) * 2: 5}


def test_latest_fulfill_line_settles_equal_times(spark, orders):
    same = orders["fulfill_line"].withColumn("FULFILLLINELASTUPDATEDATE", F.lit(datetime(2024, 1, 1)))
    assert bag(erp.latest_fulfill_lines(same), "FULFILLLINEID") == {(2,): 1, (4,): 1}


def test_open_orders(orders):
    opened = erp.open_orders(erp.orders_base(orders))
    # Charges and lines without SKU are left out.
    assert bag(opened, "SKU") == {("SKU100",): 3}


def test_join_by_parts_and_by_key(spark):
    bl = spark.createDataFrame(
        [("1", "23", "SA", None, "W", "123SAW")],
        "ItemCode string, Customer string, Company string, CustomerDeliveryAddressCode string, ShipPoint1 string, BuyListDetailKey string",
    )
    ob = spark.createDataFrame(
        [("1", "23", "SA", "", "W", "123SAW"), ("12", "3", "SA", None, "W", "123SAW")],
        "SKU string, CustomerNumber string, Company string, DeliveryAddressCode string, OrganizationCode string, OrdersBaseKey string",
    )
    assert erp.join_buylist_orders(bl, ob).count() == 0  # a null part meets nothing unless asked for
    assert erp.join_buylist_orders(bl, ob, match_blank=True).count() == 1
    assert erp.join_buylist_orders(bl, ob, by="key", match_blank=True).count() == 2
    assert one(erp.join_buylist_orders(bl, ob.limit(0), how="left")).Order_SKU is None


def test_views_follow_the_tables(spark, buylist, orders):
    spark.sql("CREATE SCHEMA IF NOT EXISTS scut")
    for role, name in erp.BUYLIST_TABLES.items():
        buylist[role].write.mode("overwrite").saveAsTable(f"scut.{name}")
    for role, name in erp.ORDER_TABLES.items():
        orders[role].write.mode("overwrite").saveAsTable(f"scut.{name}")
    erp.create_views(spark)
    other = spark.newSession()
    found, plain = other.table("scut.vw_Orders_Base"), erp.orders_base(orders)
    assert found.dtypes == plain.dtypes and bag(found) == bag(plain)
    found, plain = other.table("scut.vw_BuyList_DetailInfo"), erp.buylist_detail(buylist)
    assert found.dtypes == plain.dtypes and bag(found) == bag(plain) and found.count() == 5
    buylist["list_customer"].write.mode("append").saveAsTable("scut.Buylist_Customer")
    assert spark.newSession().table("scut.vw_BuyList_DetailInfo").count() == 9
    # A session that has listed a table's files before sees new ones after a refresh, as of any table.
    other.catalog.refreshTable("scut.Buylist_Customer")
    assert other.table("scut.vw_BuyList_DetailInfo").count() == 9
    buylist["list_customer"].limit(0).write.mode("overwrite").saveAsTable("scut.Buylist_Customer")
    assert spark.newSession().sql("SELECT count(*) AS n FROM scut.vw_BuyList_DetailInfo WHERE Customer IS NULL").first().n == 3
    # The views may stand in another schema than their tables.
    erp.create_views(spark, "reporting", tables="scut", views=[erp.ORDERS_VIEW])
    assert spark.newSession().table("reporting.vw_Orders_Base").count() == 5


def test_views_of_the_given_tables(spark, sf_dir):
    """The compiled text and the frame give the same rows over the whole given tables."""
    from stockflow.plans.spec import view_frame, view_sql
    from verification import shapes

    for view, tables in ((erp.BUYLIST_VIEW, shapes.buylist_tables(spark, sf_dir)), (erp.ORDERS_VIEW, shapes.order_tables(spark, sf_dir))):
        for role, df in tables.items():
            df.createOrReplaceTempView(f"given_{role}")
        text = spark.sql(view_sql(view, {role: f"given_{role}" for role in tables}))
        plain = view_frame(view, tables)
        assert text.columns == plain.columns and text.exceptAll(plain).isEmpty() and plain.exceptAll(text).isEmpty()


def test_load_date_is_the_eastern_date():
    late = datetime.fromisoformat("2026-05-19T02:30:00+00:00")
    assert RunContext("r", late).load_date.isoformat() == "2026-05-18"


def test_master_columns_are_not_shuffled_with_items(buylist):
    """Items meet their lists before their master, which no size turns into a broadcast."""
    plan = erp.buylist_detail(buylist)._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in plan.splitlines() if "Join" in line)
    assert "_item" in last and "_master" in last and "strategy=merge" in last


def test_header_columns_are_not_shuffled_again(orders):
    """Lines meet items and fulfil lines before the header side."""
    plan = erp.orders_base(orders)._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in plan.splitlines() if "Join" in line)
    assert "Inner" in last and "_line_header" in last and "_fulfill" not in last


@pytest.mark.parametrize("match_blank", [False, True])
def test_views_joined_from_their_tables(spark, buylist, orders, match_blank):
    """Equal to the join of the whole views, also with a master that repeats a key."""
    parts = [(b, o) for b, o in erp.SHARED_KEY]
    first = erp.orders_base(orders).where("SKU IS NOT NULL").select(*(o for _, o in parts)).collect()
    extra = [
        {"BUYLISTKEY": 3 + i, "ITEMKEY": k, "ITEM_CODE": r.SKU, "COMPANY_CODE": r.Company, "SHIP_POINT1": r.OrganizationCode}
        for i, r in enumerate(first) for k in (10, None)
    ]
    customers = [{"BUYLISTKEY": 3 + i, "CUSTOMER": r.CustomerNumber, "DELIVERY_ADDRESS_CODE": r.DeliveryAddressCode} for i, r in enumerate(first)]

    def more(role, rows):
        kinds = dict(buylist[role].dtypes)
        return buylist[role].unionByName(padded(spark, list(kinds), {c: "long" for c, k in kinds.items() if k == "bigint"}, rows))

    lists = buylist | {
        "item": more("item", extra),
        "header": more("header", [{"BUYLISTKEY": 3 + i} for i in range(len(first))]),
        "list_customer": more("list_customer", customers),
        "master": more("master", [{"ItemKey": 10, "SKUDescription": "again"}]),
    }
    of_lists, of_orders = ["BuyListDetailKey", "BuyListCode", "SKUDescription", "Customer"], ["OrdersBaseKey", "OrderNumber", "AccountNumber", "SKU"]
    got = erp.buylist_orders(lists, orders, of_lists, of_orders, match_blank=match_blank)
    names = [*of_lists, *(f"Order_{c}" for c in of_orders)]
    want = erp.join_buylist_orders(erp.buylist_detail(lists), erp.orders_base(orders), match_blank=match_blank)
    assert got.columns == names
    assert bag(got, *names) == bag(want, *names) and got.where("SKUDescription = 'again'").count() > 0


def test_lists_meet_orders_without_the_master(buylist, orders):
    """No computed key is shuffled, and the master is looked up after lists and orders have met."""
    joined = erp.buylist_orders(buylist, orders, ["BuyListDetailKey"], ["OrdersBaseKey"], match_blank=True)
    plan = joined._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [(len(line) - len(line.lstrip(" :+-")), line) for line in plan if "Join " in line]
    assert " = _master#" in min(joins)[1] and sum(" = _master#" in line for _, line in joins) == 1
    assert not any("BuyListDetailKey" in line for line in plan[1:])
