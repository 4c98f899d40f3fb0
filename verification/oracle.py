"""The same results in plain SQL for DuckDB, written independently of the operators.

Only the shapes are shared with the Spark side.
"""

from __future__ import annotations

from verification import shapes
from verification.shapes import in_duckdb

# Characters to strip: the same set as Python's str.strip().
_BLANKS = " || ".join(
    f"chr({c})"
    for c in [
        *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239,
        8287, 12288,
    ]
)
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _strip(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def _number(x: str) -> str:
    text = _strip(f"CAST({x} AS VARCHAR)")
    return f"CASE WHEN regexp_full_match({text}, '{_NUMBER}') THEN TRY_CAST({text} AS DOUBLE) END"


def _quantity(x: str) -> str:
    return f"CAST(ceil({_number(x)}) AS BIGINT)"


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes.items()) + "\n"


def _shape(shape: str) -> str:
    return in_duckdb(shape)


_BI = {f"b_{role}": _shape(s) for role, s in shapes.BUYLIST.items()}
_OR = {f"o_{role}": _shape(s) for role, s in shapes.ORDERS.items()}

_MIDDLE = """CASE WHEN length(s.PARTYSITENUMBER) - length(replace(s.PARTYSITENUMBER, '-', '')) >= 2
  THEN split_part(s.PARTYSITENUMBER, '-', 2) END"""

_BUYLIST = """
SELECT i.COMPANY_CODE AS Company, i.BUYING_LIST_CODE AS BuyListCode, i.ITEM_CODE AS ItemCode,
  i.STATE_ITEM_REFERENCE_NUMBER AS StateReferenceNumber,
  i.CUSTOMER_CROSS_REFERENCE AS CustomerCrossReference, i.COMMERCIAL_BU AS CommercialBu,
  i.NABCA_STATE_ITEM_NUMBER AS NABCA_ItemNumber, i.STATUS AS BuylistItemStatus,
  i.ORDER_TYPE AS BuylistItemOrderType, i.SHIP_POINT1 AS ShipPoint1,
  i.START_DATE AS BuylistItemStartDate, i.END_DATE AS BuylistItemEndDate,
  i.REGISTRATION_KEY AS RegistrationKey, i.COMPLIANCE_STATUS AS BuylistItemComplianceStatus,
  h.BUYING_LIST_DESCRIPTION AS BuyingListDescription, h.STATE AS State,
  h.FROM_DATE AS BuylistHeaderFromDate, h.TO_DATE AS BuylistToDate, h.STATUS AS BuyListHeaderStatus,
  m.* EXCLUDE (ItemKey, StatusFlag, StatusFlagDescription, SUPPLIER_DESCRIPTION),
  m.StatusFlag AS ItemMasterStatusFlag, m.StatusFlagDescription AS ItemMasterStatusFlagDescription,
  m.SUPPLIER_DESCRIPTION AS "Subdivision/SupplierDescription",
  lc.STATUS AS BuylistCustomerStatus, lc.CUSTOMER AS Customer,
  lc.DELIVERY_ADDRESS_CODE AS CustomerDeliveryAddressCode, c.* EXCLUDE (CustomerKey),
  concat(i.ITEM_CODE, lc.CUSTOMER, i.COMPANY_CODE, lc.DELIVERY_ADDRESS_CODE, i.SHIP_POINT1) AS BuyListDetailKey
FROM b_item i
JOIN b_header h ON i.BUYLISTKEY = h.BUYLISTKEY
LEFT JOIN b_master m ON i.ITEMKEY = m.ItemKey
LEFT JOIN b_list_customer lc ON i.BUYLISTKEY = lc.BUYLISTKEY
LEFT JOIN b_customer c ON lc.CUSTOMERKEY = c.CustomerKey"""

_LATEST_FULFILL = """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY FULFILLLINESOURCEORDERNUMBER, FULFILLLINESOURCELINENUMBER
    ORDER BY FULFILLLINELASTUPDATEDATE DESC NULLS LAST, FULFILLLINEID DESC NULLS LAST,
      FULFILLLINELINEID DESC NULLS LAST, FULFILLLINEHEADERID DESC NULLS LAST,
      FULFILLLINEINVENTORYORGANIZATIONID DESC NULLS LAST, FULFILLLINEFULFILLORGID DESC NULLS LAST,
      FULFILLLINESUBINVENTORY DESC NULLS LAST, FULFILLLINESHIPPEDQTY DESC NULLS LAST) AS n
  FROM o_fulfill_line) WHERE n = 1"""

_ORDERS = f"""
SELECT h.HEADERCUSTOMERPONUMBER AS PONumber, h.HEADERORDERNUMBER AS OrderNumber,
  CASE WHEN l.LINESOURCEORDERSYSTEM = 'SYS21' THEN l.LINESOURCELINENUMBER ELSE l.LINEDISPLAYLINENUMBER END AS LineNumber,
  h.HEADERORDEREDDATE AS OrderDate, CAST(h.HEADERCREATIONDATE AS DATE) AS HeaderCreateDate,
  h.HEADERONHOLD AS HeaderOnHold, l.LINEONHOLD AS LineOnHold, CAST(l.LINECREATIONDATE AS DATE) AS LineCreateDate,
  l.LINESCHEDULESHIPDATE AS RequestedShipDate, l.LINEACTUALSHIPDATE AS ShipDate,
  h.HEADERSTATUSCODE AS OrderStatus, l.LINESTATUSCODE AS LineStatusCode,
  h.HEADERORDERTYPECODE AS HeaderTypeCode, l.LINEORDEREDQTY AS OrderQty,
  f.FULFILLLINESHIPPEDQTY AS FulfillLineShippedQTY, l.LINEINVENTORYITEMID AS SKUID,
  i.ITEMBASEPEOITEMNUMBER AS SKU, i.ITEMTRANSLATIONPEODESCRIPTION AS SKUDesc, l.LINEORDEREDUOM AS LineUOM,
  substring(n.ATTRIBUTE1, 1, 2) AS Company, substring(n.ATTRIBUTE1, 3, 2) AS Plant,
  substring(d.ATTRIBUTE1, 3, 2) AS Stockroom, n.ORGANIZATIONCODE AS OrganizationCode,
  u.ORGANIZATIONUNITTRANSLATIONPEONAME AS OrganizationName, f.FULFILLLINESUBINVENTORY AS LineSubInventory,
  h.HEADERSOLDTOPARTYID AS CustomerID, a.ACCOUNTNUMBER AS CustomerNumber,
  {_MIDDLE} AS DeliveryAddressCode, p.PARTYNAME AS CustomerName,
  a.ACCOUNTNUMBER AS AccountNumber, a.ACCOUNTNAME AS AccountName,
  concat(i.ITEMBASEPEOITEMNUMBER, a.ACCOUNTNUMBER, substring(n.ATTRIBUTE1, 1, 2), {_MIDDLE}, n.ORGANIZATIONCODE) AS OrdersBaseKey
FROM o_line l
JOIN o_header h ON l.LINEHEADERID = h.HEADERID
  AND h.HEADERSTATUSCODE NOT IN ('DOO_DRAFT', 'DOO_REFERENCE') AND h.HEADERSOURCEDOCUMENTTYPECODE IS NULL
LEFT JOIN o_address o ON h.HEADERID = o.ORDERADDRESSHEADERID AND o.ORDERADDRESSUSETYPE = 'SHIP_TO'
LEFT JOIN o_party_site s ON o.ORDERADDRESSPARTYSITEID = s.PARTYSITEID
LEFT JOIN o_account a ON h.HEADERSOLDTOPARTYID = a.PARTYID
LEFT JOIN o_party p ON h.HEADERSOLDTOPARTYID = p.PARTYID
LEFT JOIN o_item i ON l.LINEINVENTORYITEMID = i.ITEMBASEPEOINVENTORYITEMID
  AND l.LINEINVENTORYORGANIZATIONID = i.ITEMBASEPEOINVENTORYORGANIZATIONID AND i.ITEMTRANSLATIONPEOLANGUAGE = 'US'
LEFT JOIN latest_fulfill f ON l.LINEID = f.FULFILLLINELINEID AND l.LINEHEADERID = f.FULFILLLINEHEADERID
  AND l.LINEINVENTORYORGANIZATIONID = f.FULFILLLINEINVENTORYORGANIZATIONID
LEFT JOIN o_org n ON f.FULFILLLINEFULFILLORGID = n.ORGANIZATIONID
LEFT JOIN o_org_unit u ON f.FULFILLLINEFULFILLORGID = u.ORGANIZATIONID
LEFT JOIN o_allocation x ON f.FULFILLLINEID = x.FULFILL_LINE_ID AND x.CONTEXT_CODE = 'Allocation Details'
LEFT JOIN o_sub_inventory d ON f.FULFILLLINEFULFILLORGID = d.ORGANIZATION_ID
  AND x.ATTRIBUTE_CHAR1 = d.SECONDARY_INVENTORY_NAME"""

_INPUT = (
    "Company", "BuyListCode", "ItemCode", "StateReferenceNumber", "BuylistItemStatus",
    "CustomerCrossReference", "Customer", "CustomerDeliveryAddressCode", "CustomerFullName",
    "BuyListDetailKey",
)


def _ranked(reference: str = "CustomerCrossReference") -> str:
    order = ["BuylistItemStatus", *(c for c in _INPUT if c != "BuylistItemStatus")]
    return f"""
SELECT {', '.join(_INPUT)} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY {reference}, Customer, CustomerDeliveryAddressCode
    ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in order)}) AS rn
  FROM buylist WHERE Company = 'SA') WHERE rn = 1"""


_XWALK_ORDER = (
    "BuylistItemStatus", "Company", "BuyListCode", "CATN32", "StateReferenceNumber", "CSRF32",
    "Customer", "CustomerDeliveryAddressCode", "CustomerFullName", "BuyListDetailKey", "BLCD32",
    "Key3",
)
_XWALK = f"""
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY Key3
    ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in _XWALK_ORDER)}) AS n
  FROM (SELECT *, concat_ws('', BLCD32, StateReferenceNumber) AS Key3 FROM (
    SELECT Company, BuyListCode, ItemCode AS CATN32, StateReferenceNumber, BuylistItemStatus,
      CustomerCrossReference AS CSRF32, Customer, CustomerDeliveryAddressCode, CustomerFullName,
      BuyListDetailKey, concat_ws(' ', Customer, CustomerDeliveryAddressCode) AS BLCD32
    FROM ranked))) WHERE n = 1"""

_TO_BUYLIST = {**_BI, "buylist": _BUYLIST}
_TO_XWALK = {**_TO_BUYLIST, "ranked": _ranked(), "xwalk": _XWALK}
_TO_ORDERS = {**_OR, "latest_fulfill": _LATEST_FULFILL, "orders_base": _ORDERS}

_JOINED = """
SELECT i.*, concat_ws('', i.location, i.item) AS Key2, x.CATN32, x.CSRF32
FROM inventory i LEFT JOIN xwalk x ON concat_ws('', i.location, i.item) = x.Key3"""
_TO_JOINED = {**_TO_XWALK, "inventory": _shape(shapes.INVENTORY), "joined": _JOINED}

_TRANSIT = """
SELECT t.*, r.CSRF32, r.CSRF32 AS SIRF32, 'Oracle' AS "Data Source", t.CUSTOMER || r.CSRF32 AS Key,
  'In Transit' AS "PO Status 2"
FROM (
  SELECT DISTINCT concat(CustomerNumber, ' ', DeliveryAddressCode) AS CUSTOMER, OrderNumber AS ORDN55,
    OrderQty AS CASES_ORD, FulfillLineShippedQTY AS CASES_STP, SKU AS CATN55,
    CAST(RequestedShipDate AS DATE) AS CSRQ40
  FROM orders_base
  WHERE LineStatusCode <> 'CANCELED' AND OrderNumber NOT LIKE '%PALLET%' AND SKU NOT LIKE '%PALLET%'
    AND HeaderTypeCode NOT IN ('BAILMENT - RETURN ORDER', 'BILLING ORDER', 'DESTRUCTION ORDER',
      'INTERCOMPANY ORDER', 'RETURN ORDER')
    AND RequestedShipDate BETWEEN DATE '1998-01-05' - INTERVAL 30 DAY AND DATE '1998-01-05') t
LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY BLCD32, CATN32
    ORDER BY BuylistItemStatus ASC NULLS FIRST, CSRF32 ASC NULLS FIRST, Key3 ASC NULLS FIRST) AS n
  FROM xwalk) WHERE n = 1) r ON t.CUSTOMER = r.BLCD32 AND t.CATN55 = r.CATN32"""

# The staged file: rename, strip, round up, zero fill, drop header lines, keep the last row.
_CLEAN = f"""
SELECT event_id, ts, {_strip('location')} AS location, {_strip('item')} AS item,
  coalesce({_quantity('maxorderqty')}, 0) AS max_order_qty,
  coalesce({_quantity('onhand_qty')}, 0) AS on_hand_qty,
  coalesce({_quantity('total_in_transit_qty')}, 0) AS in_transit_qty
FROM raw_file"""
_HEADERS = "SELECT * FROM clean WHERE location IN ('location', 'Location')"
_BODY = "SELECT * FROM clean WHERE location NOT IN ('location', 'Location') OR location IS NULL"
_RANKED_BODY = """
SELECT *, row_number() OVER (PARTITION BY location, item ORDER BY ts DESC, event_id DESC) AS n FROM body"""
_TO_STAGED = {
    "raw_file": _shape(shapes.RAW_FILE),
    "clean": _CLEAN,
    "headers": _HEADERS,
    "body": _BODY,
    "ranked_body": _RANKED_BODY,
    "staged": "SELECT * EXCLUDE (n) FROM ranked_body WHERE n = 1",
}

_SHEET_ROWS = f"SELECT *, {_strip('report_title')} AS place FROM sheet WHERE column4 IS NOT NULL AND ({_number('column11')}) IS NOT NULL"
_CODE = "CASE place WHEN 'ABQ' THEN '1056497 001' WHEN 'ATL' THEN '1056527 001' WHEN 'SAV' THEN '1056529 001' END"
_TO_SHEET = {"sheet": _shape(shapes.SHEET), "sheet_rows": _SHEET_ROWS}
_REASON = f"""CASE WHEN num IS NULL AND NOT (code IS NULL AND (column4 IS NULL OR NOT coalesce(regexp_matches(column11, '[0-9]'), FALSE)))
    THEN 'BAD_QUANTITY' WHEN num IS NOT NULL AND column4 IS NULL THEN 'NO_ITEM' END"""
_SHEET_JUDGED = f"""
SELECT report_title, column4, column11, place, code, num, {_REASON} AS reason FROM (
  SELECT *, {_CODE} AS code, {_number('column11')} AS num FROM (SELECT *, {_strip('report_title')} AS place FROM sheet))"""
_NORMAL = f"""
SELECT column4 AS "Customer Item Reference", {_CODE} AS "Dpl Customer (key)", {_number('column11')} AS "On Hand Loaded"
FROM sheet_rows"""

_DOMAIN = f"""
SELECT 'file' AS source, location, item, on_hand_qty, in_transit_qty, max_order_qty FROM staged
UNION ALL
SELECT 'reported', location, item, on_hand_qty, in_transit_qty, NULL FROM reported
UNION ALL
SELECT 'sheet', {_CODE}, column4, CAST(ceil({_number('column11')}) AS BIGINT), NULL, NULL FROM sheet_rows"""
_TO_DOMAIN = {**_TO_STAGED, **_TO_SHEET, "reported": _shape(shapes.INVENTORY), "inventory": _DOMAIN}
_TO_UPLOAD = {**_TO_XWALK, **_TO_DOMAIN, "joined": _JOINED}

_UPLOAD = """
SELECT CATN32 AS Product, location AS "CompanyCode-Ship", on_hand_qty AS "On Hand",
  {amount} AS "In Transit"
FROM joined {more} WHERE CATN32 IS NOT NULL AND location IS NOT NULL AND item IS NOT NULL"""
_QUARANTINE = """
SELECT *, CASE WHEN location IS NULL THEN 'NO_LOCATION' WHEN item IS NULL THEN 'NO_ITEM' ELSE 'NO_SKU_MATCH' END AS reason
FROM joined WHERE CATN32 IS NULL OR location IS NULL OR item IS NULL"""

_REASON = """CASE WHEN location IS NULL THEN 'NO_LOCATION' WHEN item IS NULL THEN 'NO_ITEM'
  WHEN CATN32 IS NULL THEN 'NO_SKU_MATCH' END"""

_NORM = "ltrim(upper(" + _strip("{0}") + "), '0')"


def _fanout(name: str, left: str, right: str, on: list[tuple[str, str]], where: str = "TRUE") -> str:
    match = " AND ".join(f"l.{a} = r.{b}" for a, b in on)
    return f"""
SELECT '{name}' AS join_name, CAST(count(*) AS BIGINT) AS rows_before,
  CAST(sum(greatest(m, 1)) AS BIGINT) AS rows_after,
  CAST(count(*) FILTER (m = 0) AS BIGINT) AS rows_unmatched, CAST(max(m) AS BIGINT) AS max_matches
FROM (SELECT l.id, count(r.{on[0][1]}) AS m
  FROM (SELECT *, row_number() OVER () AS id FROM {left}) l
  LEFT JOIN (SELECT * FROM {right} WHERE {where}) r ON {match} GROUP BY l.id)"""


def _metric(check: str, column: str | None, value: str, status: str) -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{check}' AS check_name, {name} AS column_name, value, {status} AS status "
        f"FROM (SELECT CAST({value} AS BIGINT) AS value FROM raw_file)"
    )


def _metrics(*metrics: str) -> str:
    return _with(raw_file=_shape(shapes.RAW_FILE)) + "\nUNION ALL\n".join(metrics)


_FAIL_ANY = "CASE WHEN value > 0 THEN 'FAIL' ELSE 'PASS' END"
_WARN_ANY = "CASE WHEN value > 0 THEN 'WARN' ELSE 'PASS' END"


def _lost(column: str) -> str:
    return f"count(*) FILTER ({column} IS NOT NULL AND ({_number(column)}) IS NULL)"


def _reconcile(a: str, b: str, keys: str) -> str:
    return f"""
SELECT status, CAST(count(*) AS BIGINT) AS n_keys, CAST(sum(na) AS BIGINT) AS rows_a, CAST(sum(nb) AS BIGINT) AS rows_b
FROM (SELECT na, nb, CASE WHEN nb = 0 THEN 'ONLY_A' WHEN na = 0 THEN 'ONLY_B' WHEN na <> nb THEN 'COUNT_DIFFERS' ELSE 'SAME' END AS status
  FROM (SELECT {keys}, count(*) FILTER (side = 'a') AS na, count(*) FILTER (side = 'b') AS nb
    FROM (SELECT 'a' AS side, {keys} FROM ({a}) UNION ALL SELECT 'b', {keys} FROM ({b})) GROUP BY {keys}))
GROUP BY status"""


_DIMENSIONS = {
    "total": "CAST(NULL AS VARCHAR)",
    "odbc": "CASE WHEN lower(data_file_path) LIKE '%odbc%' THEN 'Yes' ELSE 'No' END",
    "workbook": "main_file_name",
    "redundant": "redundant_y_n_maybe",
    "migrated": "in_fabric_y_n_maybe",
    "delivery": "manual_v_auto",
    "refresh": "refresh_frequency",
}
# Every record that is not blank names its data purpose.
_TO_REGISTER = {
    "everything": _shape(shapes.REGISTER),
    "register": "SELECT * FROM everything WHERE data_purpose IS NOT NULL",
}
_USES = """
SELECT data_file_path, sheet_table_name, sub_query_file_name, count(*) AS n_rows
FROM register WHERE data_file_path <> '' GROUP BY ALL"""
_SHARED = """
SELECT data_file_path, sheet_table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows, count(*) AS n_queries
FROM uses GROUP BY ALL HAVING count(*) > 1"""

_KEPT_EVENTS = """
SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS n
FROM events"""

ORACLE: dict[str, str] = {
    "sanitize_identifier": """
        SELECT p_partkey, trim(regexp_replace(lower(trim(' ' || p_brand || '  ' || p_type || '#')), '[^a-z0-9]+', '_', 'g'), '_') AS identifier
        FROM part""",
    "concat_rules": _with(lc=_shape(shapes.BUYLIST["list_customer"])) + """
        SELECT BUYLISTKEY, concat(CUSTOMER, ' ', DELIVERY_ADDRESS_CODE) AS by_sql,
          concat_ws(' ', CUSTOMER, DELIVERY_ADDRESS_CODE) AS by_combine,
          CUSTOMER || DELIVERY_ADDRESS_CODE AS by_amp FROM lc""",
    "delivery_segment": _with(s=_shape(shapes.ORDERS["party_site"]))
    + f"SELECT PARTYSITEID, {_MIDDLE} AS segment FROM s",
    "stage_standardize": _with(**_TO_STAGED) + "SELECT * FROM staged",
    "standardize_rejects": _with(**_TO_STAGED) + """
        SELECT *, 'EMBEDDED_HEADER' AS reason FROM headers
        UNION ALL SELECT * EXCLUDE (n), 'DUPLICATE_KEY' FROM ranked_body WHERE n > 1""",
    "drop_embedded_headers": _with(raw_file=_shape(shapes.RAW_FILE)) + f"""
        SELECT * REPLACE ({_strip('location')} AS location) FROM raw_file
        WHERE coalesce({_strip('location')}, '') NOT IN ('location', 'Location')""",
    "dedupe_keep_last": f"SELECT * EXCLUDE (n) FROM ({_KEPT_EVENTS}) WHERE n = 1",
    "dedupe_rejects": f"SELECT * EXCLUDE (n), 'DUPLICATE_KEY' AS reason FROM ({_KEPT_EVENTS}) WHERE n > 1",
    "audit_columns": """
        SELECT *, DATE '2026-05-18' AS load_date, TIMESTAMP '2026-05-18 14:30:00' AS load_timestamp,
          'orders.parquet' AS src_file_name, 'run-0001' AS pipeline_run_id FROM orders""",
    "dq_columns": _metrics(
        *(_metric("columns", c, f"count({c})", "'PASS'") for c in ("location", "item", "maxorderqty", "onhand_qty")),
        _metric("columns", "pack_size", "count(NULL)", "'WARN'"),
        _metric("columns", "total_in_transit_qty", "count(total_in_transit_qty)", "'WARN'"),
    ),
    "dq_row_count": """
        SELECT 'row_count' AS check_name, CAST(NULL AS VARCHAR) AS column_name, count(*) AS value,
          CASE WHEN count(*) < 1000 THEN 'FAIL' WHEN count(*) > 50000 THEN 'WARN' ELSE 'PASS' END AS status
        FROM lineitem""",
    "dq_nulls": _metrics(
        *(_metric("nulls", c, f"count(*) - count({c})", _FAIL_ANY) for c in ("location", "item", "onhand_qty"))
    ),
    "dq_unique_key": _with(f=_shape(shapes.ORDERS["fulfill_line"])) + """
        SELECT 'unique_key' AS check_name, 'FULFILLLINESOURCEORDERNUMBER,FULFILLLINESOURCELINENUMBER' AS column_name,
          CAST(sum(n - 1) AS BIGINT) AS value, CASE WHEN sum(n - 1) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
        FROM (SELECT count(*) AS n FROM f GROUP BY FULFILLLINESOURCEORDERNUMBER, FULFILLLINESOURCELINENUMBER)""",
    "dq_coercions": _metrics(
        *(_metric("lost_quantity", c, _lost(c), _WARN_ANY) for c in ("onhand_qty", "total_in_transit_qty", "maxorderqty"))
    ),
    "latest_fulfill_line": _with(o_fulfill_line=_OR["o_fulfill_line"]) + _LATEST_FULFILL,
    "fulfill_null_keys": _with(f=_shape(shapes.ORDERS["fulfill_line"])) + """
        SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_groups, CAST(sum(n) - count(*) AS BIGINT) AS n_lost
        FROM (SELECT count(*) AS n FROM f
          WHERE FULFILLLINESOURCEORDERNUMBER IS NULL OR FULFILLLINESOURCELINENUMBER IS NULL
          GROUP BY FULFILLLINESOURCEORDERNUMBER, FULFILLLINESOURCELINENUMBER)""",
    "latest_snapshot": _with(s=_shape(shapes.SNAPSHOTS)) + """
        SELECT s.* FROM s JOIN (
          SELECT source, load_date, pipeline_run_id, row_number() OVER (PARTITION BY source, load_date
            ORDER BY max(load_timestamp) DESC, pipeline_run_id DESC) AS n
          FROM s GROUP BY source, load_date, pipeline_run_id) w
        USING (source, load_date, pipeline_run_id) WHERE n = 1""",
    "snapshot_from_log": _with(s=_shape(shapes.RUN_ROWS), l=_shape(shapes.RUN_ROWS_LOG)) + """
        SELECT s.* FROM s JOIN (
          SELECT load_date, pipeline_run_id, row_number() OVER (PARTITION BY load_date
            ORDER BY load_timestamp DESC, pipeline_run_id DESC) AS n
          FROM l WHERE status = 'SUCCESS') w
        USING (load_date, pipeline_run_id) WHERE n = 1""",
    "sheet_detected": """
        SELECT event_type AS site, CAST(user_id AS VARCHAR) AS item_no, CAST(value AS VARCHAR) AS on_hand_qty,
          CASE WHEN event_id % 2 = 0 THEN 'north' ELSE 'south' END AS _src_file, event_id + 10 AS _src_row
        FROM events""",
    "buylist_detail_view": _with(**_TO_BUYLIST) + "SELECT * FROM buylist",
    "orders_base_view": _with(**_TO_ORDERS) + "SELECT * FROM orders_base",
    "open_orders": _with(**_TO_ORDERS)
    + "SELECT * FROM orders_base WHERE ShipDate IS NULL AND SKU <> 'PALLETSLIPCHG'",
    "join_fanout_metrics": _with(
        **_OR,
        latest_fulfill=_LATEST_FULFILL,
        headers="""SELECT * FROM o_header WHERE HEADERSTATUSCODE NOT IN ('DOO_DRAFT', 'DOO_REFERENCE')
          AND HEADERSOURCEDOCUMENTTYPECODE IS NULL""",
    )
    + "\nUNION ALL\n".join(
        [
            _fanout("address", "headers", "o_address", [("HEADERID", "ORDERADDRESSHEADERID")], "ORDERADDRESSUSETYPE = 'SHIP_TO'"),
            _fanout("account", "headers", "o_account", [("HEADERSOLDTOPARTYID", "PARTYID")]),
            _fanout(
                "item", "o_line", "o_item",
                [
                    ("LINEINVENTORYITEMID", "ITEMBASEPEOINVENTORYITEMID"),
                    ("LINEINVENTORYORGANIZATIONID", "ITEMBASEPEOINVENTORYORGANIZATIONID"),
                ],
                "ITEMTRANSLATIONPEOLANGUAGE = 'US'",
            ),
            _fanout(
                "fulfill_line", "o_line", "latest_fulfill",
                [
                    ("LINEID", "FULFILLLINELINEID"),
                    ("LINEHEADERID", "FULFILLLINEHEADERID"),
                    ("LINEINVENTORYORGANIZATIONID", "FULFILLLINEINVENTORYORGANIZATIONID"),
                ],
            ),
            _fanout("allocation", "latest_fulfill", "o_allocation", [("FULFILLLINEID", "FULFILL_LINE_ID")], "CONTEXT_CODE = 'Allocation Details'"),
        ]
    ),
    "ranked_crosswalk": _with(**_TO_BUYLIST) + _ranked(),
    "crosswalk_keys": _with(**_TO_XWALK) + "SELECT * FROM xwalk",
    "crosswalk_keys_by_state_reference": _with(
        **{**_TO_XWALK, "ranked": _ranked("StateReferenceNumber")}
    )
    + "SELECT * FROM xwalk",
    "crosswalk_rule_difference": _with(
        **_TO_XWALK,
        ranked_state=_ranked("StateReferenceNumber"),
        xwalk_state=_XWALK.replace("FROM ranked)", "FROM ranked_state)"),
    )
    + _reconcile("SELECT * FROM xwalk_state", "SELECT * FROM xwalk", "Key3"),
    "crosswalk_join": _with(**_TO_JOINED) + "SELECT * FROM joined",
    "crosswalk_match_rate": _with(**_TO_JOINED) + """
        SELECT count(*) AS n_rows, count(CATN32) AS n_matched, round(count(CATN32) / count(*), 6) AS match_rate,
          CASE WHEN count(CATN32) / count(*) < 0.8 THEN 'FAIL' ELSE 'PASS' END AS status FROM joined""",
    "crosswalk_unmatched": _with(**_TO_JOINED)
    + f"SELECT location, item, {_REASON} AS reason, count(*) AS n_rows FROM joined WHERE {_REASON} IS NOT NULL GROUP BY ALL",
    "publish_match_rate": _with(**_TO_JOINED, judged=f"SELECT {_REASON} AS reason, count(*) AS n FROM joined GROUP BY ALL") + """
        SELECT sum(n)::BIGINT AS n_rows, sum(n) FILTER (reason IS NULL)::BIGINT AS n_matched,
          round(sum(n) FILTER (reason IS NULL) / sum(n), 6) AS match_rate,
          CASE WHEN sum(n) FILTER (reason IS NULL) / sum(n) >= 0.8 THEN 'PASS' ELSE 'FAIL' END AS status,
          string_agg(reason || '=' || n, ',' ORDER BY reason) AS reasons FROM judged""",
    "near_miss_keys": _with(**_TO_JOINED) + f"""
        SELECT u.location, u.item, u.n_rows, x.candidate, x.n_candidates
        FROM (SELECT location, item, count(*) AS n_rows FROM joined WHERE {_REASON} = 'NO_SKU_MATCH' GROUP BY location, item) u
        JOIN (SELECT {_NORM.format('BLCD32')} AS a, {_NORM.format('StateReferenceNumber')} AS b,
            min(CATN32) AS candidate, count(DISTINCT CATN32) AS n_candidates FROM xwalk GROUP BY ALL) x
        ON {_NORM.format('u.location')} = x.a AND {_NORM.format('u.item')} = x.b""",
    "in_transit": _with(**_TO_ORDERS, **_TO_XWALK) + _TRANSIT,
    "distributor_normalize": _with(**_TO_SHEET) + _NORMAL,
    "unmapped_locations": _with(**_TO_SHEET)
    + f"SELECT place AS location, count(*) AS n_rows FROM sheet_rows WHERE ({_CODE}) IS NULL GROUP BY place",
    "append_sources": _with(**_TO_DOMAIN) + "SELECT * FROM inventory",
    "upload_rows": _with(**_TO_UPLOAD)
    + _UPLOAD.format(amount="CAST(coalesce(in_transit_qty, 0) AS DOUBLE)", more=""),
    "upload_rows_in_transit": _with(**_TO_UPLOAD, **_TO_ORDERS, transit=_TRANSIT)
    + _UPLOAD.format(
        amount="coalesce(moving, 0.0)",
        more="""LEFT JOIN (SELECT Key, sum(CASES_STP) AS moving FROM transit GROUP BY Key) t
          ON joined.location || joined.CSRF32 = t.Key""",
    ),
    "upload_quarantine": _with(**_TO_UPLOAD)
    + _QUARANTINE,
    "quarantine_by_reason": _with(**_TO_UPLOAD, quarantine=_QUARANTINE)
    + "SELECT reason, count(*) AS n_rows FROM quarantine GROUP BY reason",
    "sheet_rejects": _with(sheet=_shape(shapes.SHEET), judged=_SHEET_JUDGED)
    + "SELECT report_title, column4, column11, reason FROM judged WHERE reason IS NOT NULL",
    "sheet_quarantine": _with(sheet=_shape(shapes.SHEET), judged=_SHEET_JUDGED) + """
        SELECT reason, count(*) AS n_rows FROM (
          SELECT coalesce(reason, CASE WHEN num IS NOT NULL AND code IS NULL THEN
            CASE WHEN place IS NULL THEN 'NO_LOCATION' ELSE 'UNMAPPED_LOCATION' END END) AS reason FROM judged)
        WHERE reason IS NOT NULL GROUP BY reason""",
    "buylist_orders_join": _with(**_TO_BUYLIST, **_TO_ORDERS) + """
        SELECT b.BuyListDetailKey, b.BuyListCode, b.BuylistItemStatus, o.OrdersBaseKey AS Order_OrdersBaseKey,
          o.OrderNumber AS Order_OrderNumber, o.LineNumber AS Order_LineNumber, o.OrderQty AS Order_OrderQty
        FROM buylist b JOIN orders_base o ON coalesce(b.ItemCode, '') = coalesce(o.SKU, '')
          AND coalesce(b.Customer, '') = coalesce(o.CustomerNumber, '') AND coalesce(b.Company, '') = coalesce(o.Company, '')
          AND coalesce(b.CustomerDeliveryAddressCode, '') = coalesce(o.DeliveryAddressCode, '')
          AND coalesce(b.ShipPoint1, '') = coalesce(o.OrganizationCode, '')""",
    "buylist_orders_join_strict": _with(**_TO_BUYLIST, **_TO_ORDERS) + """
        SELECT b.BuyListDetailKey, b.BuyListCode, o.OrderNumber AS Order_OrderNumber, o.LineNumber AS Order_LineNumber
        FROM buylist b JOIN orders_base o ON b.ItemCode = o.SKU AND b.Customer = o.CustomerNumber
          AND b.Company = o.Company AND b.CustomerDeliveryAddressCode = o.DeliveryAddressCode
          AND b.ShipPoint1 = o.OrganizationCode""",
    "transition_gap": _with(**_TO_BUYLIST) + """
        SELECT DISTINCT Company, BuyListCode, ItemCode, TransitionSKU FROM buylist b
        WHERE TransitionSKU IS NOT NULL AND NOT EXISTS (SELECT 1 FROM buylist o
          WHERE o.Company = b.Company AND o.BuyListCode = b.BuyListCode AND o.ItemCode = b.TransitionSKU)""",
    "transition_items": _with(**_TO_BUYLIST)
    + "SELECT DISTINCT ItemCode, TransitionSKU FROM buylist WHERE TransitionSKU IS NOT NULL",
    "transition_open_orders": _with(**_TO_BUYLIST, **_TO_ORDERS) + """
        SELECT * FROM orders_base WHERE ShipDate IS NULL AND SKU <> 'PALLETSLIPCHG'
          AND SKU IN (SELECT ItemCode FROM buylist WHERE TransitionSKU IS NOT NULL)""",
    "reconcile_tables": _reconcile(
        "SELECT l_orderkey AS order_key FROM lineitem",
        "SELECT o_orderkey AS order_key FROM orders",
        "order_key",
    ),
    "reconcile_view": _with(**_TO_BUYLIST) + _reconcile(
        "SELECT * FROM buylist",
        "SELECT COMPANY_CODE AS Company, BUYING_LIST_CODE AS BuyListCode, ITEM_CODE AS ItemCode FROM b_item",
        "Company, BuyListCode, ItemCode",
    ),
    "reconcile_changes": _with(a=_shape(shapes.ORDERS_BEFORE), b=_shape(shapes.ORDERS_AFTER), f="""
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a, b
        FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey""") + "\nUNION ALL\n".join([
        f"""SELECT o_orderkey, 'CHANGED' AS status, '{c}' AS column_name, a.{c}::VARCHAR AS value_a, b.{c}::VARCHAR AS value_b,
          1::BIGINT AS n_rows FROM f WHERE a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL AND a.{c} IS DISTINCT FROM b.{c}"""
        for c in ("o_custkey", "o_orderstatus", "o_orderpriority")
    ] + [f"""SELECT o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'ONLY_A' ELSE 'ONLY_B' END, NULL, NULL, NULL, 1::BIGINT
          FROM f WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL"""]),
    "run_log": _with(runs=_shape(shapes.RUNS)) + """
        SELECT * REPLACE (
          CASE WHEN notebook_type = 'source' THEN raw_table END AS raw_table,
          CASE WHEN notebook_type = 'source' THEN stg_table END AS stg_table,
          coalesce(rows_raw, 0) AS rows_raw, coalesce(rows_stg, 0) AS rows_stg,
          coalesce(rows_core, 0) AS rows_core, coalesce(rows_out, 0) AS rows_out,
          coalesce(message, '') AS message) FROM runs""",
    "registry_current": _with(h=_shape(shapes.HISTORY)) + """
        SELECT f.* EXCLUDE (n) REPLACE (l.src_path AS src_path, l.last_successful_run AS last_successful_run,
          l.last_run_id AS last_run_id, l.last_raw_row_count AS last_raw_row_count,
          l.last_stg_row_count AS last_stg_row_count)
        FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY last_successful_run, last_run_id) AS n FROM h) f
        JOIN (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY last_successful_run DESC, last_run_id DESC) AS n FROM h) l
        ON f.source_name = l.source_name WHERE f.n = 1 AND l.n = 1""",
    "source_audit": _with(**_TO_REGISTER) + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dimension, {value} AS value, count(*) AS n_rows, count(DISTINCT sub_query_file_name) AS n_queries FROM register GROUP BY ALL"
        for name, value in _DIMENSIONS.items()
    ),
    "shared_sources": _with(**_TO_REGISTER, uses=_USES) + _SHARED,
    "shared_source_members": _with(**_TO_REGISTER, uses=_USES, shared=_SHARED) + """
        SELECT u.* FROM uses u JOIN shared s ON u.data_file_path = s.data_file_path
          AND u.sheet_table_name IS NOT DISTINCT FROM s.sheet_table_name""",
}
ORACLE["run_log_failures"] = (
    ORACLE["run_log"] + " WHERE status = 'FAILURE' AND load_date = DATE '2024-01-15'"
)
