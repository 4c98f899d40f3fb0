"""The given tables in the shape of the ERP extracts, source files and operational tables.

Each shape is one SELECT over whole tables in SQL that Spark and DuckDB both
read, so a query and its check start from the same rows. Misses, nulls and
variants come from CASE expressions; no shape leaves rows out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

GIVEN = ("part", "supplier", "customer", "orders", "lineitem", "events", "documents")

CUSTOMER_NUMBER = "CAST(1000000 + {key} AS STRING)"


def _number(key: str) -> str:
    return CUSTOMER_NUMBER.format(key=key)


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


_SKU = "lpad(CAST(l_partkey AS STRING), 12, '0')"

BUYLIST = {
    "item": f"""
        SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE l_orderkey END AS BUYLISTKEY,
          CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN -1 - l_partkey ELSE l_partkey END AS ITEMKEY,
          CASE WHEN l_suppkey % 5 = 0 THEN 'SI' ELSE 'SA' END AS COMPANY_CODE,
          'L' || {_text('l_suppkey')} AS BUYING_LIST_CODE,
          {_text('l_partkey')} AS ITEM_CODE,
          {_SKU} AS STATE_ITEM_REFERENCE_NUMBER,
          CASE WHEN l_linenumber <= 2 THEN NULL ELSE 'X' || {_text('l_partkey')} END AS CUSTOMER_CROSS_REFERENCE,
          l_returnflag AS COMMERCIAL_BU,
          'N' || {_text('l_partkey')} AS NABCA_STATE_ITEM_NUMBER,
          {_text('l_linenumber')} AS STATUS,
          l_linestatus AS ORDER_TYPE,
          CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'W' || {_text('l_suppkey % 25')} END AS SHIP_POINT1,
          CAST(l_shipdate AS DATE) AS START_DATE,
          CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS END_DATE,
          'R' || {_text('l_suppkey')} AS REGISTRATION_KEY,
          CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'REJECTED' END AS COMPLIANCE_STATUS
        FROM {{lineitem}}""",
    "header": f"""
        SELECT o_orderkey AS BUYLISTKEY, 'List ' || {_text('o_orderkey')} AS BUYING_LIST_DESCRIPTION,
          substring(o_orderpriority, 3, 2) AS STATE, CAST(o_orderdate AS DATE) AS FROM_DATE,
          CAST(o_orderdate + INTERVAL 90 DAYS AS DATE) AS TO_DATE, o_orderstatus AS STATUS
        FROM {{orders}}""",
    "master": f"""
        SELECT p_partkey AS ItemKey,
          CASE WHEN p_type = 'PROMO' THEN {_text('p_partkey + 1')} END AS TransitionSKU,
          p_name AS SKUDescription, p_type AS ItemType, {_text('p_size')} AS BottleSize,
          {_text('p_size * 50')} AS BottleSizeinML, 'Size ' || {_text('p_size')} AS StandardSizeDescription,
          'S' || {_text('p_size % 10')} AS SizeCode, 'Code ' || {_text('p_size % 10')} AS SizeCodeDescription,
          p_brand AS BrandDescription, substring(p_brand, 7, 1) AS BrandOwnership,
          p_brand || ' ' || p_type AS SubBrandDescription,
          CASE WHEN p_size > 40 THEN 'PREMIUM' WHEN p_size > 20 THEN 'CORE' END AS PriceTierDescription,
          substring(p_type, 1, 2) AS PackageType, p_type AS PackageTypeDescription,
          CASE WHEN p_size > 45 THEN 'I' ELSE 'A' END AS StatusFlag,
          CASE WHEN p_size > 45 THEN 'Inactive' ELSE 'Active' END AS StatusFlagDescription,
          CASE WHEN p_size > 25 THEN 'Y' ELSE 'N' END AS CoPackInd, p_name AS ItemGroupMinorDescription,
          'SCC' || {_text('p_partkey')} AS SCCCode, 'UPC' || {_text('p_partkey')} AS UPCCode,
          p_retailprice AS FullCost, CAST(p_size AS DOUBLE) AS Litreage_9L, p_brand AS SUPPLIER_DESCRIPTION,
          p_type AS ABAItemType, CAST(p_size + 1 AS DOUBLE) AS WeightperStandardUnit,
          {_text('p_size % 12')} AS StandardCaseSize, p_size AS BottlesPerCase
        FROM {{part}}""",
    "list_customer": f"""
        SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS BUYLISTKEY,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS CUSTOMERKEY,
          o_orderstatus AS STATUS, {_number('o_custkey')} AS CUSTOMER,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE '001' END AS DELIVERY_ADDRESS_CODE
        FROM {{orders}}
        UNION ALL
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END, o_custkey, 'X',
          {_number('o_custkey')}, '002'
        FROM {{orders}}""",
    "customer": f"""
        SELECT c_custkey AS CustomerKey, c_name || ' Ltd' AS CustomerFullName, c_name AS CustomerName,
          CASE WHEN c_nationkey > 20 THEN 'H' ELSE 'A' END AS CustomerStatus,
          CASE WHEN c_nationkey > 10 THEN 'Y' ELSE 'N' END AS VMIIndicator, c_mktsegment AS SubChannel,
          'D' || {_text('c_nationkey')} AS DepletionCode, substring(c_mktsegment, 1, 3) AS DeliveryType,
          '001' AS InvoiceAddressCode, 'L' || {_text('c_nationkey')} AS BuyingListCode,
          c_nationkey AS LeadTimeInDays, {_number('c_custkey')} AS DepletionCustomerNumber,
          '9' || {_text('c_nationkey')} AS DepletionDelCode
        FROM {{customer}}""",
}

ORDERS = {
    "line": f"""
        SELECT l_orderkey * 10 + l_linenumber AS LINEID, l_orderkey AS LINEHEADERID,
          CASE WHEN l_linenumber = 6 THEN NULL ELSE l_partkey END AS LINEINVENTORYITEMID,
          l_partkey % 25 AS LINEINVENTORYORGANIZATIONID,
          CASE l_returnflag WHEN 'R' THEN 'SYS21' WHEN 'A' THEN 'OTHER' END AS LINESOURCEORDERSYSTEM,
          {_text('l_linenumber')} AS LINESOURCELINENUMBER,
          {_text('l_linenumber')} || '.1' AS LINEDISPLAYLINENUMBER,
          CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS LINEONHOLD,
          CASE WHEN l_returnflag = 'R' THEN 'CANCELED' WHEN l_linenumber = 7 THEN NULL ELSE 'AWAIT_SHIP' END AS LINESTATUSCODE,
          'CS' AS LINEORDEREDUOM, l_shipdate + INTERVAL 10 HOURS AS LINECREATIONDATE,
          l_shipdate AS LINESCHEDULESHIPDATE,
          CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 26 HOURS END AS LINEACTUALSHIPDATE,
          l_quantity AS LINEORDEREDQTY
        FROM {{lineitem}}""",
    "header": f"""
        SELECT o_orderkey AS HEADERID,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS HEADERSOLDTOPARTYID,
          'PO' || {_text('o_orderkey')} AS HEADERCUSTOMERPONUMBER,
          CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'PALLET' ELSE 'SO' END || {_text('o_orderkey')} AS HEADERORDERNUMBER,
          CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS HEADERONHOLD,
          CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_orderstatus = 'O' THEN 'OPEN'
            WHEN o_orderpriority = '1-URGENT' THEN 'DOO_DRAFT' WHEN o_orderpriority = '2-HIGH' THEN 'DOO_REFERENCE'
            WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'OPEN' END AS HEADERSTATUSCODE,
          CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'RETURN ORDER' WHEN '5-LOW' THEN NULL
            ELSE 'STANDARD ORDER' END AS HEADERORDERTYPECODE,
          CASE WHEN o_totalprice > 450000 THEN 'PO' END AS HEADERSOURCEDOCUMENTTYPECODE,
          o_orderdate AS HEADERORDEREDDATE, o_orderdate + INTERVAL 10 HOURS AS HEADERCREATIONDATE
        FROM {{orders}}""",
    "fulfill_line": f"""
        SELECT l_partkey AS FULFILLLINEID, l_orderkey * 10 + l_linenumber AS FULFILLLINELINEID,
          l_orderkey AS FULFILLLINEHEADERID, l_partkey % 25 AS FULFILLLINEINVENTORYORGANIZATIONID,
          CASE WHEN l_linenumber = 5 THEN NULL ELSE l_suppkey END AS FULFILLLINEFULFILLORGID,
          CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE {_text('l_orderkey')} END AS FULFILLLINESOURCEORDERNUMBER,
          {_text('l_linenumber')} AS FULFILLLINESOURCELINENUMBER,
          'SUB' || {_text('l_suppkey % 5')} AS FULFILLLINESUBINVENTORY,
          CASE WHEN l_quantity > 49 THEN NULL ELSE l_shipdate END AS FULFILLLINELASTUPDATEDATE,
          l_quantity AS FULFILLLINESHIPPEDQTY
        FROM {{lineitem}}""",
    "address": """
        SELECT o_orderkey AS ORDERADDRESSHEADERID, o_custkey * 10 + 1 AS ORDERADDRESSPARTYSITEID,
          CASE WHEN o_orderpriority = '2-HIGH' THEN 'BILL_TO' ELSE 'SHIP_TO' END AS ORDERADDRESSUSETYPE
        FROM {orders}
        UNION ALL
        SELECT o_orderkey, o_custkey * 10 + 2,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'SHIP_TO' ELSE 'BILL_TO' END
        FROM {orders}""",
    "party_site": f"""
        SELECT c_custkey * 10 + 1 AS PARTYSITEID,
          {_number('c_custkey')} || CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '' WHEN 'BUILDING' THEN '-001'
            WHEN 'FURNITURE' THEN '--X' WHEN 'HOUSEHOLD' THEN '-001-X' ELSE '-001-X-Y' END AS PARTYSITENUMBER
        FROM {{customer}}
        UNION ALL
        SELECT c_custkey * 10 + 2, {_number('c_custkey')} || '-002-X' FROM {{customer}}""",
    "account": f"""
        SELECT c_custkey AS PARTYID, {_number('c_custkey')} AS ACCOUNTNUMBER, 'Account ' || c_name AS ACCOUNTNAME
        FROM {{customer}}""",
    "party": "SELECT c_custkey AS PARTYID, c_name AS PARTYNAME FROM {customer}",
    "item": f"""
        SELECT p_partkey AS ITEMBASEPEOINVENTORYITEMID, p_partkey % 25 AS ITEMBASEPEOINVENTORYORGANIZATIONID,
          CASE WHEN p_type = 'ECONOMY' AND p_size > 40 THEN 'PALLETSLIPCHG' ELSE {_text('p_partkey')} END AS ITEMBASEPEOITEMNUMBER,
          p_name AS ITEMTRANSLATIONPEODESCRIPTION,
          CASE WHEN p_type = 'LARGE' THEN 'CA' ELSE 'US' END AS ITEMTRANSLATIONPEOLANGUAGE
        FROM {{part}}
        UNION ALL
        SELECT p_partkey, p_partkey % 25, {_text('p_partkey')}, 'le ' || p_name, 'FR' FROM {{part}}""",
    "org": f"""
        SELECT s_suppkey AS ORGANIZATIONID,
          CASE WHEN s_suppkey % 5 = 0 THEN 'SI' ELSE 'SA' END || lpad({_text('s_nationkey')}, 2, '0') AS ATTRIBUTE1,
          'W' || {_text('s_suppkey % 25')} AS ORGANIZATIONCODE
        FROM {{supplier}}""",
    "org_unit": """
        SELECT s_suppkey AS ORGANIZATIONID, s_name AS ORGANIZATIONUNITTRANSLATIONPEONAME FROM {supplier}""",
    "allocation": f"""
        SELECT p_partkey AS FULFILL_LINE_ID,
          CASE WHEN p_type = 'SMALL' THEN 'Other' ELSE 'Allocation Details' END AS CONTEXT_CODE,
          'SUB' || {_text('p_size % 5')} AS ATTRIBUTE_CHAR1
        FROM {{part}}""",
    "sub_inventory": f"""
        SELECT s_suppkey AS ORGANIZATION_ID, 'SUB' || {_text('s_nationkey % 5')} AS SECONDARY_INVENTORY_NAME,
          'SA' || lpad({_text('s_nationkey')}, 2, '0') AS ATTRIBUTE1
        FROM {{supplier}}""",
}

# Inventory under standard names: what distributors report for the customers of the lists.
INVENTORY = f"""
    SELECT {_number('o_custkey')} || ' 001' AS location,
      CASE WHEN l_linenumber = 5 THEN {_text('l_partkey')} WHEN l_linenumber = 4 THEN ' ' || {_SKU} || chr(9)
        WHEN l_linenumber = 7 THEN NULL ELSE {_SKU} END AS item,
      CAST(l_quantity AS BIGINT) AS on_hand_qty,
      CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS in_transit_qty
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""

# A distributor file as text, with the flaws of such files; k is a number from the event.
_K = "regexp_extract(props, '([0-9]+)', 1)"
RAW_FILE = f"""
    SELECT event_id, ts,
      CASE WHEN value < 0.5 THEN 'location' WHEN value < 1 THEN ' Location' WHEN value > 200 THEN NULL
        ELSE chr(9) || event_type || ' ' END AS location,
      lpad({_text('user_id')}, 12, '0') || chr(160) AS item,
      {_K} || '.5' AS maxorderqty,
      CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '1,' || {_K} WHEN 2 THEN ' ' || {_K} || ' '
        WHEN 3 THEN {_K} || '.2' WHEN 4 THEN {_K} || 'd' WHEN 5 THEN 'inf' WHEN 6 THEN '' WHEN 7 THEN '-' || {_K} || '.7'
        WHEN 8 THEN {_K} || 'e2' ELSE {_K} END AS onhand_qty,
      CASE WHEN event_id % 4 = 0 THEN NULL ELSE {_K} END AS total_in_transit_qty
    FROM {{events}}"""

# Distributor sheet: title lines above the data have no item or no numeric quantity.
SHEET = f"""
    SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ABQ' WHEN 'BUILDING' THEN 'ATL' WHEN 'FURNITURE' THEN ' SAV '
        WHEN 'HOUSEHOLD' THEN 'DAL' END AS report_title,
      CASE WHEN c_acctbal < 0 THEN NULL ELSE {_text('c_custkey')} END AS column4,
      CASE WHEN c_nationkey = 24 THEN 'On Hand' ELSE {_text('c_nationkey')} || '.5' END AS column11
    FROM {{customer}}"""

RUNS = f"""
    SELECT 'run-' || {_text('event_id')} AS pipeline_run_id,
      CASE event_type WHEN 'view' THEN 'core' WHEN 'signup' THEN 'output' ELSE 'source' END AS notebook_type,
      CAST(ts AS DATE) AS load_date, ts AS load_timestamp,
      'source_' || {_text('user_id')} AS source_name,
      'raw.inventory_' || {_text('user_id')} AS raw_table, 'stg.inventory_' || {_text('user_id')} AS stg_table,
      CAST(NULL AS STRING) AS core_table, CAST(NULL AS STRING) AS out_table,
      CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
      CASE WHEN value < 5 THEN NULL ELSE event_id % 1000 END AS rows_raw,
      CASE WHEN value < 5 THEN NULL ELSE event_id % 900 END AS rows_stg,
      CAST(NULL AS BIGINT) AS rows_core, CAST(NULL AS BIGINT) AS rows_out, 'svc' AS executed_by,
      CASE WHEN event_type = 'error' THEN 'failed: ' || props END AS message
    FROM {{events}}"""

HISTORY = f"""
    SELECT 'source_' || {_text('user_id')} AS source_name, 'cust_inventory' AS domain, 'source' AS notebook_type,
      'files/' || event_type || '.csv' AS src_path, 'csv' AS src_format,
      CASE WHEN event_type = 'click' THEN 'sftp' ELSE 'lakehouse' END AS delivery_method,
      'daily' AS refresh_cadence, '["location","item"]' AS expected_columns, '["location"]' AS business_key,
      event_id % 100 AS min_row_count, CAST(0 AS BIGINT) AS max_row_count, event_type AS source_owner,
      ts AS first_loaded, ts AS last_successful_run, 'run-' || {_text('event_id')} AS last_run_id,
      event_id % 1000 AS last_raw_row_count, event_id % 900 AS last_stg_row_count, TRUE AS is_active
    FROM {{events}}"""

SNAPSHOTS = f"""
    SELECT event_type AS source, CAST(ts AS DATE) AS load_date, ts AS load_timestamp,
      'run-' || {_text('user_id')} AS pipeline_run_id, event_id, value
    FROM {{events}}"""


# Rows of three runs a day, by partition; the fourth run's are of failed runs.
RUN_ROWS = """
    SELECT event_id, value, ts, CAST(ts AS DATE) AS load_date,
      'run-' || CAST(user_id % 4 AS STRING) AS pipeline_run_id
    FROM {events}"""
RUN_ROWS_LOG = f"""
    SELECT load_date, pipeline_run_id, max(ts) AS load_timestamp, 'stg.events' AS stg_table,
      CASE WHEN pipeline_run_id = 'run-3' THEN 'FAILURE' ELSE 'SUCCESS' END AS status
    FROM ({RUN_ROWS}) GROUP BY load_date, pipeline_run_id"""

# Lines of two sheets with other title lines, other column orders and other names.
SHEET_LINES = """
    SELECT CASE WHEN event_id % 2 = 0 THEN 'north' ELSE 'south' END AS _src_file, CAST(0 AS BIGINT) AS _src_block,
      event_id + 10 AS _src_row,
      CASE WHEN event_id % 2 = 0 THEN array(event_type, 'x', CAST(user_id AS STRING), CAST(value AS STRING))
        ELSE array(CAST(value AS STRING), CAST(user_id AS STRING), event_type, NULL) END AS cells
    FROM {events}
    UNION ALL SELECT * FROM VALUES
      ('north', CAST(0 AS BIGINT), CAST(0 AS BIGINT), array('Inventory report', NULL, NULL, NULL)),
      ('north', CAST(0 AS BIGINT), CAST(1 AS BIGINT), array('Site', 'Note', 'Item No', 'On-Hand Qty')),
      ('south', CAST(0 AS BIGINT), CAST(0 AS BIGINT), array('Item No', 'as of', 'today', NULL)),
      ('south', CAST(0 AS BIGINT), CAST(1 AS BIGINT), array(NULL, NULL, NULL, NULL)),
      ('south', CAST(0 AS BIGINT), CAST(2 AS BIGINT), array('Stock', 'ITEM NO', 'site ', NULL)),
      ('south', CAST(0 AS BIGINT), CAST(3 AS BIGINT), array('Stock', 'ITEM NO', 'site ', NULL))"""


# Two versions of the orders: the second lacks some, has new ones, and others' values.
ORDERS_BEFORE = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM {orders}"
ORDERS_AFTER = """
    SELECT o_orderkey,
      CASE WHEN o_custkey % 89 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
      CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderpriority
    FROM {orders} WHERE NOT (o_orderpriority = '5-LOW' AND o_custkey % 31 = 0)
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_orderpriority FROM {orders} WHERE o_custkey % 53 = 0"""


def _unless_blank(expr: str) -> str:
    return f"CASE WHEN n_chars % 101 = 0 THEN NULL ELSE {expr} END"


REGISTER = "SELECT " + ", ".join(
    f"{_unless_blank(expr)} AS {name}"
    for name, expr in {
        "main_file_name": "lang",
        "sub_query_file_name": f"'Q' || {_text('n_chars % 997')}",
        "data_purpose": "'Inventory'",
        "customer": "source",
        "data_file_path": "CASE WHEN n_chars % 11 = 0 THEN 'ODBC: ' || source WHEN n_chars % 13 = 0 THEN '' ELSE 'share/' || source END",
        "sheet_table_name": "CASE WHEN n_chars % 7 = 0 THEN NULL ELSE lang END",
        "refresh_frequency": "CASE WHEN n_chars % 3 = 0 THEN 'Daily' WHEN n_chars % 3 = 1 THEN 'Weekly' END",
        "manual_v_auto": "CASE WHEN n_chars % 2 = 0 THEN 'Manual' ELSE 'PowerQuery' END",
        "redundant_y_n_maybe": "CASE WHEN n_chars % 5 = 0 THEN 'Maybe' END",
        "in_fabric_y_n_maybe": "CASE WHEN n_chars % 9 = 0 THEN 'Yes' END",
        "notes": "source || ' notes'",
        "mcode_audit": "'Done'",
        "mcode_notes": "''",
    }.items()
) + " FROM {documents}"


def shaped(
    spark: SparkSession, sf_dir: str, shape: str, given: dict[str, DataFrame] | None = None
) -> DataFrame:
    """A shape over the given parquet files; ``given`` keeps the scans to share."""
    given = {} if given is None else given
    used = set(re.findall(r"\{(\w+)\}", shape))
    for table in used - given.keys():
        given[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(shape, **{table: given[table] for table in used})


def buylist_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    given: dict[str, DataFrame] = {}
    tables = {role: shaped(spark, sf_dir, shape, given) for role, shape in BUYLIST.items()}
    tables["master"] = tables["master"].withColumnRenamed(
        "SUPPLIER_DESCRIPTION", "Subdivision/SupplierDescription"
    )
    return tables


def order_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    given: dict[str, DataFrame] = {}
    return {role: shaped(spark, sf_dir, shape, given) for role, shape in ORDERS.items()}


def in_duckdb(shape: str) -> str:
    return shape.format(**{t: t for t in GIVEN})
