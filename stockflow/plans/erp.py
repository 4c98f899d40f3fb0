"""The two ERP views as DataFrame functions over a mapping of role -> table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.config import (
    CANCELED_LINE_STATUS,
    CHARGE_SKUS,
    EXCLUDED_HEADER_STATUSES,
    EXCLUDED_ORDER_TYPES,
    PALLET_FRAGMENT,
)
from stockflow.operators.joins import lookup
from stockflow.operators.keyed import all_present, latest_by, null_key_groups
from stockflow.plans.spec import Join, Newest, Pick, View, column, frame, packed_frame, view_frame, view_sql

Tables = Mapping[str, DataFrame]

# --- Fixed values: table and column names of the ERP ------------------------

BUYLIST_TABLES = {
    "item": "Buylist_Item",
    "header": "Buylist_Header",
    "master": "ItemMaster",
    "list_customer": "Buylist_Customer",
    "customer": "CustomerMaster",
}

ORDER_TABLES = {
    "line": "OracleSCMDistributedOrderOrchestrationLineExtract",
    "header": "OracleSCMDistributedOrderOrchestrationHeaderExtract",
    "fulfill_line": "OracleSCMDistributedOrderOrchestrationFulfillLineExtract",
    "address": "OracleSCMDistributedOrderOrchestrationOrderAddressExtract",
    "party_site": "OracleCommonPartySite",
    "account": "OracleCommonCustomerAccount",
    "party": "OracleCommonPartyExtract",
    "item": "OracleCommonItemExtract",
    "org": "OracleSCMCommonInvOrgParametersExtract",
    "org_unit": "OracleCommonOrganizationUnit",
    "allocation": "OracleCustomSalesOrdersFullFillLineEFF",
    "sub_inventory": "OracleCustomSubInventoryDetails",
}

BUYLIST_ITEM_COLUMNS = {
    "Company": "COMPANY_CODE",
    "BuyListCode": "BUYING_LIST_CODE",
    "ItemCode": "ITEM_CODE",
    "StateReferenceNumber": "STATE_ITEM_REFERENCE_NUMBER",
    "CustomerCrossReference": "CUSTOMER_CROSS_REFERENCE",
    "CommercialBu": "COMMERCIAL_BU",
    "NABCA_ItemNumber": "NABCA_STATE_ITEM_NUMBER",
    "BuylistItemStatus": "STATUS",
    "BuylistItemOrderType": "ORDER_TYPE",
    "ShipPoint1": "SHIP_POINT1",
    "BuylistItemStartDate": "START_DATE",
    "BuylistItemEndDate": "END_DATE",
    "RegistrationKey": "REGISTRATION_KEY",
    "BuylistItemComplianceStatus": "COMPLIANCE_STATUS",
}
BUYLIST_HEADER_COLUMNS = {
    "BuyingListDescription": "BUYING_LIST_DESCRIPTION",
    "State": "STATE",
    "BuylistHeaderFromDate": "FROM_DATE",
    "BuylistToDate": "TO_DATE",
    "BuyListHeaderStatus": "STATUS",
}
ITEM_MASTER_COLUMNS = {
    "TransitionSKU": "TransitionSKU",
    "SKUDescription": "SKUDescription",
    "ItemType": "ItemType",
    "BottleSize": "BottleSize",
    "BottleSizeinML": "BottleSizeinML",
    "StandardSizeDescription": "StandardSizeDescription",
    "SizeCode": "SizeCode",
    "SizeCodeDescription": "SizeCodeDescription",
    "BrandDescription": "BrandDescription",
    "BrandOwnership": "BrandOwnership",
    "SubBrandDescription": "SubBrandDescription",
    "PriceTierDescription": "PriceTierDescription",
    "PackageType": "PackageType",
    "PackageTypeDescription": "PackageTypeDescription",
    "ItemMasterStatusFlag": "StatusFlag",
    "ItemMasterStatusFlagDescription": "StatusFlagDescription",
    "CoPackInd": "CoPackInd",
    "ItemGroupMinorDescription": "ItemGroupMinorDescription",
    "SCCCode": "SCCCode",
    "UPCCode": "UPCCode",
    "FullCost": "FullCost",
    "Litreage_9L": "Litreage_9L",
    "Subdivision/SupplierDescription": "Subdivision/SupplierDescription",
    "ABAItemType": "ABAItemType",
    "WeightperStandardUnit": "WeightperStandardUnit",
    "StandardCaseSize": "StandardCaseSize",
    "BottlesPerCase": "BottlesPerCase",
}
BUYLIST_CUSTOMER_COLUMNS = {
    "BuylistCustomerStatus": "STATUS",
    "Customer": "CUSTOMER",
    "CustomerDeliveryAddressCode": "DELIVERY_ADDRESS_CODE",
}
CUSTOMER_MASTER_COLUMNS = {
    "CustomerFullName": "CustomerFullName",
    "CustomerName": "CustomerName",
    "CustomerStatus": "CustomerStatus",
    "VMIIndicator": "VMIIndicator",
    "SubChannel": "SubChannel",
    "DepletionCode": "DepletionCode",
    "DeliveryType": "DeliveryType",
    "InvoiceAddressCode": "InvoiceAddressCode",
    "BuyingListCode": "BuyingListCode",
    "LeadTimeInDays": "LeadTimeInDays",
    "DepletionCustomerNumber": "DepletionCustomerNumber",
    "DepletionDelCode": "DepletionDelCode",
}
BUYLIST_DETAIL_COLUMNS = (
    *BUYLIST_ITEM_COLUMNS,
    *BUYLIST_HEADER_COLUMNS,
    *ITEM_MASTER_COLUMNS,
    *BUYLIST_CUSTOMER_COLUMNS,
    *CUSTOMER_MASTER_COLUMNS,
    "BuyListDetailKey",
)
ORDERS_BASE_COLUMNS = (
    "PONumber", "OrderNumber", "LineNumber", "OrderDate", "HeaderCreateDate", "HeaderOnHold",
    "LineOnHold", "LineCreateDate", "RequestedShipDate", "ShipDate", "OrderStatus",
    "LineStatusCode", "HeaderTypeCode", "OrderQty", "FulfillLineShippedQTY", "SKUID", "SKU",
    "SKUDesc", "LineUOM", "Company", "Plant", "Stockroom", "OrganizationCode",
    "OrganizationName", "LineSubInventory", "CustomerID", "CustomerNumber",
    "DeliveryAddressCode", "CustomerName", "AccountNumber", "AccountName", "OrdersBaseKey",
)

# Parts of the key the two views share, in order: buying-list name, orders name.
SHARED_KEY = (
    ("ItemCode", "SKU"),
    ("Customer", "CustomerNumber"),
    ("Company", "Company"),
    ("CustomerDeliveryAddressCode", "DeliveryAddressCode"),
    ("ShipPoint1", "OrganizationCode"),
)

# Source order and line number of a fulfil line.
FULFILL_KEY = ("FULFILLLINESOURCEORDERNUMBER", "FULFILLLINESOURCELINENUMBER")

SOURCE_SYSTEM_WITH_OWN_LINES = "SYS21"

# ----------------------------------------------------------------------------


def catalog_tables(
    spark: SparkSession, roles: Mapping[str, str], schema: str = "scut"
) -> dict[str, DataFrame]:
    return {role: spark.table(f"{schema}.{name}") for role, name in roles.items()}


def _pick(role: str, columns: Mapping[str, str], **keys: str) -> Pick:
    """Columns under their view names, plus join keys under names of their own."""
    return Pick(role, {new: column(old) for new, old in {**columns, **keys}.items()})


def _sql_concat(*names: str) -> str:
    """``sql_concat`` as text."""
    return "concat(" + ", ".join(f"coalesce({column(n)}, '')" for n in names) + ")"


def _middle_segment(name: str) -> str:
    """``middle_segment`` as text."""
    parts = f"split({column(name)}, '-')"
    return f"CASE WHEN size({parts}) >= 3 THEN get({parts}, 1) END"


# Customers are joined to their master before the list fans out, so the master
# lookup runs once per list customer and not once per item of a list. Headers get
# their customers at that grain too: an item meets its list in one join, and its
# master, the widest of the tables, last, so that its columns are not shuffled
# with the items.
_LIST_CUSTOMERS = Join(
    _pick("list_customer", BUYLIST_CUSTOMER_COLUMNS, _customer_list="BUYLISTKEY", _customer="CUSTOMERKEY"),
    _pick("customer", CUSTOMER_MASTER_COLUMNS, _customer_master="CustomerKey"),
    (("_customer", "_customer_master"),),
    spread_by=("_customer_list",),
)
_LISTS = Join(
    _pick("header", BUYLIST_HEADER_COLUMNS, _header="BUYLISTKEY"),
    _LIST_CUSTOMERS,
    (("_header", "_customer_list"),),
)
_LIST_ITEMS = Join(
    _pick("item", BUYLIST_ITEM_COLUMNS, _list="BUYLISTKEY", _item="ITEMKEY"),
    _LISTS,
    (("_list", "_header"),),
    "inner",
)
_MASTER = _pick("master", ITEM_MASTER_COLUMNS, _master="ItemKey")
BUYLIST_VIEW = View(
    "vw_BuyList_DetailInfo",
    Join(
        _LIST_ITEMS,
        _MASTER,
        (("_item", "_master"),),
        spread_by=("_list",),
        shuffled=True,
    ),
    BUYLIST_DETAIL_COLUMNS,
    {"BuyListDetailKey": _sql_concat(*(buylist for buylist, _ in SHARED_KEY))},
)


def buylist_detail(t: Tables, whole: bool = False, columns: Sequence[str] = ()) -> DataFrame:
    """One row per buying-list item and customer of the list.

    ``whole`` is for readers of all columns: it moves fewer bytes, but neither a
    filter nor a choice of columns reaches the tables. ``columns`` are those a
    reader needs if it needs few.
    """
    return packed_frame(BUYLIST_VIEW, t) if whole else view_frame(BUYLIST_VIEW, t, columns)


FULFILL_NEWEST = Newest(
    FULFILL_KEY,
    "FULFILLLINELASTUPDATEDATE",
    (
        "FULFILLLINEID", "FULFILLLINELINEID", "FULFILLLINEHEADERID",
        "FULFILLLINEINVENTORYORGANIZATIONID", "FULFILLLINEFULFILLORGID",
        "FULFILLLINESUBINVENTORY", "FULFILLLINESHIPPEDQTY",
    ),
)


def latest_fulfill_lines(fulfill: DataFrame) -> DataFrame:
    """Newest fulfil line per source order and line number.

    Lines without a source order or line number share one group per remaining
    value, so one of them survives; ``fulfill_null_keys`` counts the others.
    """
    return latest_by(fulfill, FULFILL_NEWEST.keys, FULFILL_NEWEST.by, FULFILL_NEWEST.ties)


def fulfill_null_keys(fulfill: DataFrame) -> DataFrame:
    return null_key_groups(fulfill, FULFILL_KEY)


_STATUSES = ", ".join(f"'{s}'" for s in EXCLUDED_HEADER_STATUSES)
# Headers that count as orders; a null status does not.
ORDER_HEADERS = f"HEADERSTATUSCODE NOT IN ({_STATUSES}) AND HEADERSOURCEDOCUMENTTYPECODE IS NULL"


def order_headers(header: DataFrame) -> DataFrame:
    return header.where(ORDER_HEADERS)


def _header_side(detail: bool = True) -> Join:
    """Header with ship-to site, account and party: one row per header, or more when a
    header has several ship-to addresses or accounts. The party is ``detail``."""
    headers = Pick(
        "header",
        {
            "_header": "HEADERID",
            "PONumber": "HEADERCUSTOMERPONUMBER",
            "OrderNumber": "HEADERORDERNUMBER",
            "OrderDate": "HEADERORDEREDDATE",
            "HeaderCreateDate": "CAST(HEADERCREATIONDATE AS DATE)",
            "HeaderOnHold": "HEADERONHOLD",
            "OrderStatus": "HEADERSTATUSCODE",
            "HeaderTypeCode": "HEADERORDERTYPECODE",
            "CustomerID": "HEADERSOLDTOPARTYID",
        },
        ORDER_HEADERS,
    )
    sites = Pick("party_site", {"_site_id": "PARTYSITEID", "DeliveryAddressCode": _middle_segment("PARTYSITENUMBER")})
    ship_to = Pick(
        "address",
        {"_address_header": "ORDERADDRESSHEADERID", "_site": "ORDERADDRESSPARTYSITEID"},
        "ORDERADDRESSUSETYPE = 'SHIP_TO'",
    )
    accounts = Pick("account", {"_account_party": "PARTYID", "CustomerNumber": "ACCOUNTNUMBER", "AccountName": "ACCOUNTNAME"})
    parties = Pick("party", {"_party": "PARTYID", "CustomerName": "PARTYNAME"})
    addresses = Join(ship_to, sites, (("_site", "_site_id"),), spread_by=("_address_header",))
    if detail:
        customers = Join(accounts, parties, (("_account_party", "_party"),), "full", key="_customer")
        rows = Join(headers, customers, (("CustomerID", "_customer"),), spread_by=("_header",))
    else:
        rows = Join(headers, accounts, (("CustomerID", "_account_party"),), spread_by=("_header",))
    return Join(rows, addresses, (("_header", "_address_header"),), placed=True)


def _fulfill_side(detail: bool = True) -> Pick | Join:
    """Newest fulfil line, and as ``detail`` its organisation, allocation and stockroom."""
    lines = Pick(
        "fulfill_line",
        {
            "_fulfill": "FULFILLLINEID",
            "_fulfill_line": "FULFILLLINELINEID",
            "_fulfill_header": "FULFILLLINEHEADERID",
            "_fulfill_inventory_org": "FULFILLLINEINVENTORYORGANIZATIONID",
            "_fulfill_org": "FULFILLLINEFULFILLORGID",
            "LineSubInventory": "FULFILLLINESUBINVENTORY",
            "FulfillLineShippedQTY": "FULFILLLINESHIPPEDQTY",
        },
        newest=FULFILL_NEWEST,
    )
    if not detail:
        return lines
    orgs = Pick(
        "org",
        {
            "_org": "ORGANIZATIONID",
            "Company": "substring(ATTRIBUTE1, 1, 2)",
            "Plant": "substring(ATTRIBUTE1, 3, 2)",
            "OrganizationCode": "ORGANIZATIONCODE",
        },
    )
    units = Pick("org_unit", {"_unit": "ORGANIZATIONID", "OrganizationName": "ORGANIZATIONUNITTRANSLATIONPEONAME"})
    allocations = Pick(
        "allocation", {"_allocated": "FULFILL_LINE_ID", "_sub": "ATTRIBUTE_CHAR1"}, "CONTEXT_CODE = 'Allocation Details'"
    )
    stockrooms = Pick(
        "sub_inventory",
        {"_sub_org": "ORGANIZATION_ID", "_sub_name": "SECONDARY_INVENTORY_NAME", "Stockroom": "substring(ATTRIBUTE1, 3, 2)"},
    )
    line = ("_fulfill_line",)
    named = Join(orgs, units, (("_org", "_unit"),), "full", key="_organization")
    rows = Join(lines, allocations, (("_fulfill", "_allocated"),), spread_by=line)
    rows = Join(rows, named, (("_fulfill_org", "_organization"),), spread_by=line)
    return Join(rows, stockrooms, (("_fulfill_org", "_sub_org"), ("_sub", "_sub_name")), spread_by=line)


_LINES = Pick(
    "line",
    {
        "_line": "LINEID",
        "_line_header": "LINEHEADERID",
        "SKUID": "LINEINVENTORYITEMID",
        "_inventory_org": "LINEINVENTORYORGANIZATIONID",
        "LineNumber": f"CASE WHEN LINESOURCEORDERSYSTEM = '{SOURCE_SYSTEM_WITH_OWN_LINES}' THEN LINESOURCELINENUMBER"
        " ELSE LINEDISPLAYLINENUMBER END",
        "LineOnHold": "LINEONHOLD",
        "LineCreateDate": "CAST(LINECREATIONDATE AS DATE)",
        "RequestedShipDate": "LINESCHEDULESHIPDATE",
        "ShipDate": "LINEACTUALSHIPDATE",
        "LineStatusCode": "LINESTATUSCODE",
        "OrderQty": "LINEORDEREDQTY",
        "LineUOM": "LINEORDEREDUOM",
    },
)


def _order_lines(detail: bool) -> Join:
    """Lines with header, item and fulfil side."""
    items = Pick(
        "item",
        {
            "_item": "ITEMBASEPEOINVENTORYITEMID",
            "_item_org": "ITEMBASEPEOINVENTORYORGANIZATIONID",
            "SKU": "ITEMBASEPEOITEMNUMBER",
            "SKUDesc": "ITEMTRANSLATIONPEODESCRIPTION",
        },
        "ITEMTRANSLATIONPEOLANGUAGE = 'US'",
    )
    of_line = (("_line_header", "_fulfill_header"), ("_line", "_fulfill_line"), ("_inventory_org", "_fulfill_inventory_org"))
    rows = Join(_LINES, items, (("SKUID", "_item"), ("_inventory_org", "_item_org")), spread_by=("_line",))
    rows = Join(rows, _fulfill_side(detail), of_line, spread_by=("_line",), placed=True)
    return Join(rows, _header_side(detail), (("_line_header", "_header"),), "inner", placed=True)


# Lookups hang on the side they depend on: address, account and party on the
# header, organisation and allocation on the fulfil line. They run at that grain
# before the lines are joined, and lines without a fulfil line never carry null
# keys into them. Lines meet the header side last: it brings the most columns,
# which are then not shuffled again.
ORDERS_VIEW = View(
    "vw_Orders_Base",
    _order_lines(detail=True),
    ORDERS_BASE_COLUMNS,
    {"AccountNumber": column("CustomerNumber"), "OrdersBaseKey": _sql_concat(*(orders for _, orders in SHARED_KEY))},
)


def orders_base(t: Tables, whole: bool = False) -> DataFrame:
    """One row per order line over its whole life cycle, with its newest fulfil line.

    Duplicate addresses, accounts or allocations multiply rows as in any left
    join; ``fanout_metrics`` measures that. ``whole`` as in ``buylist_detail``.
    """
    return packed_frame(ORDERS_VIEW, t) if whole else view_frame(ORDERS_VIEW, t)


# What orders in transit are made of.
TRANSIT_COLUMNS = (
    "CustomerNumber", "DeliveryAddressCode", "OrderNumber", "OrderQty", "FulfillLineShippedQTY",
    "SKU", "RequestedShipDate", "LineStatusCode", "HeaderTypeCode",
)


def orders_requested(
    t: Tables, first: date, last: date, store: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """``TRANSIT_COLUMNS`` of order lines requested from ``first`` to ``last``, as a set.

    Lines come first: cancelled lines, excluded order types and lines of orders
    that do not count go before anything is looked up, and headers, addresses and
    fulfil lines are cut to those of the lines that are left, so a window of a few
    days does not move the whole history. ``store`` writes what qualifies and
    gives it back: it is then found once, and its size is known when the scans it
    cuts are planned. Lookups that bring none of the columns are left out; they
    could only repeat rows. Of the fulfil lines all rows of a wanted key stay, so
    that the newest is the same as over the whole table.
    """
    open_lines = t["line"].where(
        F.col("LINESCHEDULESHIPDATE").between(F.lit(first), F.lit(last))
        & (F.col("LINESTATUSCODE") != CANCELED_LINE_STATUS)
    )
    counted = order_headers(t["header"]).where(
        ~F.col("HEADERORDERTYPECODE").isin(*EXCLUDED_ORDER_TYPES)
        & ~F.col("HEADERORDERNUMBER").contains(PALLET_FRAGMENT)
    )
    named = counted.select(F.col("HEADERID").alias("_counted"))
    requested = store(open_lines.join(named, F.col("LINEHEADERID") == F.col("_counted"), "left_semi"))
    lines = frame(_LINES, {"line": requested})
    ids = lines.select(F.col("_line_header").alias("_wanted"))
    fulfill = t["fulfill_line"]
    of_lines = fulfill.join(
        lines.select(F.col("_line").alias("_wanted")),
        F.col("FULFILLLINELINEID") == F.col("_wanted"),
        "left_semi",
    )
    keys = store(of_lines.select(*(F.col(k).alias(f"_w{i}") for i, k in enumerate(FULFILL_KEY))).distinct())
    same = [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(FULFILL_KEY)]
    cut = dict(t) | {
        "line": requested,
        "header": counted.join(ids, F.col("HEADERID") == F.col("_wanted"), "left_semi"),
        "address": t["address"].join(
            ids, F.col("ORDERADDRESSHEADERID") == F.col("_wanted"), "left_semi"
        ),
        "fulfill_line": fulfill.join(keys, same, "left_semi"),
    }
    return frame(_order_lines(detail=False), cut).select(*TRANSIT_COLUMNS).distinct()


def create_views(
    spark: SparkSession, schema: str = "scut", tables: str | None = None, views: Sequence[View] = (BUYLIST_VIEW, ORDERS_VIEW)
) -> None:
    """Store both views in the catalog as ``schema.vw_…``, for every session of the catalog.

    The text is compiled from the declarations that the frames are built from, over
    the tables of ``tables`` (by default the same schema). A view reads its tables
    when it is queried: new rows and replaced tables appear by themselves, in a
    session that has listed a table's files before after its REFRESH TABLE.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    roles = {BUYLIST_VIEW.name: BUYLIST_TABLES, ORDERS_VIEW.name: ORDER_TABLES}
    for view in views:
        named = {role: f"{tables or schema}.{name}" for role, name in roles[view.name].items()}
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{view.name} AS {view_sql(view, named)}")


def is_open() -> Column:
    return F.col("ShipDate").isNull()


def open_orders(orders: DataFrame, charge_skus=CHARGE_SKUS) -> DataFrame:
    """Lines not shipped yet, without charge lines; a line without SKU is left out as in SQL."""
    return orders.where(is_open() & ~F.col("SKU").isin(*charge_skus))


def join_buylist_orders(
    buylist: DataFrame,
    orders: DataFrame,
    how: str = "inner",
    by: str = "parts",
    match_blank: bool = False,
) -> DataFrame:
    """Buying-list rows with their orders; order columns get the prefix ``Order_``.

    A null part of the key matches nothing, as in a plain equi-join: rows of an
    unknown customer do not meet each other, orders with a null part are left
    out before the join, and no blank key gathers rows. With ``match_blank``
    null equals empty as in the computed key, and unknown meets unknown, n by m.
    ``by="parts"`` then compares the five key parts, ``by="key"`` the computed
    keys; they have no delimiter, so '1'+'23' also meets '12'+'3'.
    """
    orders = orders.select(*(F.col(c).alias(f"Order_{c}") for c in orders.columns))
    if not match_blank:
        orders = all_present(orders, [f"Order_{o}" for _, o in SHARED_KEY])
        match = [F.col(b) == F.col(f"Order_{o}") for b, o in SHARED_KEY]
    elif by == "key":
        match = [F.col("BuyListDetailKey") == F.col("Order_OrdersBaseKey")]
    else:
        blank = F.lit("")
        match = [
            F.coalesce(F.col(b), blank) == F.coalesce(F.col(f"Order_{o}"), blank)
            for b, o in SHARED_KEY
        ]
    return buylist.join(orders, match, how)


def buylist_orders(
    lists: Tables, orders: Tables, list_columns: Sequence[str], order_columns: Sequence[str], match_blank: bool = False
) -> DataFrame:
    """``join_buylist_orders`` of both views by parts, from their tables, for the columns named.

    No part of the key is the item master's and it drops no row, so it is looked up
    for the rows that met, and not for all items of all customers. The computed keys
    are put together at the end too: only their parts are shuffled.
    """
    parts = [b for b, _ in SHARED_KEY]
    master = [c for c in list_columns if c in ITEM_MASTER_COLUMNS]
    own = [c for c in list_columns if c not in BUYLIST_VIEW.computed and c not in master]
    listed = frame(_LIST_ITEMS, lists).select(*dict.fromkeys([*parts, *own]), "_item")
    lines = [c for c in order_columns if c not in ORDERS_VIEW.computed]
    ordered = orders_base(orders).select(*dict.fromkeys([*(o for _, o in SHARED_KEY), *lines]))
    rows = join_buylist_orders(listed, ordered, match_blank=match_blank)
    rows = lookup(rows, frame(_MASTER, lists).select("_master", *master), [("_item", "_master")], [*parts, *(f"Order_{c}" for c in lines)])
    computed = {
        "BuyListDetailKey": _sql_concat(*parts),
        "Order_OrdersBaseKey": _sql_concat(*(f"Order_{o}" for _, o in SHARED_KEY)),
        "Order_AccountNumber": column("Order_CustomerNumber"),
    }
    wanted = [*list_columns, *(f"Order_{c}" for c in order_columns)]
    return rows.select(*(F.expr(computed[c]).alias(c) if c in computed else c for c in wanted))
