"""The same results in SQL over the plain columns: no message text is read back anywhere."""

from __future__ import annotations

# Column name, SQL for its text in an image, and whether the image quotes it.
_ORDERS = (
    ("O_ORDERKEY", "o_orderkey::varchar", False),
    ("O_CUSTKEY", "o_custkey::varchar", False),
    ("O_ORDERSTATUS", "{status}", True),
    ("O_TOTALPRICE", "o_totalprice::varchar", False),
    ("O_ORDERDATE", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", True),
    ("O_ORDERPRIORITY", "o_orderpriority", True),
)
_CUSTOMER = (
    ("C_CUSTKEY", "c_custkey::varchar", False),
    ("C_NAME", "c_name", True),
    ("C_NATIONKEY", "c_nationkey::varchar", False),
    ("C_ACCTBAL", "c_acctbal::varchar", False),
    ("C_MKTSEGMENT", "{segment}", True),
)
_SUPPLIER = (
    ("S_SUPPKEY", "s_suppkey::varchar", False),
    ("S_NAME", "s_name", True),
    ("S_NATIONKEY", "s_nationkey::varchar", False),
    ("S_ACCTBAL", "s_acctbal::varchar", False),
)
_LINEITEM = (
    ("L_ORDERKEY", "l_orderkey::varchar", False),
    ("L_PARTKEY", "l_partkey::varchar", False),
    ("L_SUPPKEY", "l_suppkey::varchar", False),
    ("L_LINENUMBER", "l_linenumber::varchar", False),
    ("L_QUANTITY", "l_quantity::varchar", False),
    ("L_EXTENDEDPRICE", "l_extendedprice::varchar", False),
    ("L_DISCOUNT", "l_discount::varchar", False),
    ("L_TAX", "l_tax::varchar", False),
    ("L_RETURNFLAG", "l_returnflag", True),
    ("L_LINESTATUS", "{linestatus}", True),
    ("L_SHIPDATE", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')", True),
)
_EVENTS = (
    ("EVENT_ID", "event_id::varchar", False),
    ("TS", "strftime(ts, '%Y-%m-%d %H:%M:%S')", True),
    ("USER_ID", "user_id::varchar", False),
    ("EVENT_TYPE", "event_type", True),
    ("VALUE", "({value})::varchar", False),
    ("PROPS", "{props}", False),
)


def _hash(columns, **values) -> str:
    parts = [f"'{', ' if i else ''}{n}=' || {sql.format(**values)}" for i, (n, sql, _) in enumerate(columns)]
    return "md5('{' || " + " || ".join(parts) + " || '}')"


def _json(columns, row_id: str | None = None, **values) -> str:
    parts = [f"'\"AUTO_MD5_ID\":\"' || {row_id} || '\",'"] if row_id else []
    for i, (n, sql, quoted) in enumerate(columns):
        q = '"' if quoted else ""
        parts.append(f"'{',' if i else ''}\"{n}\":{q}' || {sql.format(**values)} || '{q}'")
    return "('{' || " + " || ".join(parts) + " || '}')"


def _both(columns, name: str, **values) -> str:
    """Plain image, id, and image with the id, as columns ``<name>_img``, ``_id`` and ``_full``."""
    row_id = _hash(columns, **values)
    return (
        f"{_json(columns, **values)} AS {name}_img, {row_id} AS {name}_id, "
        f"{_json(columns, row_id, **values)} AS {name}_full"
    )


# Orders with both images, and the changes the feed derives from them.
_O = f"""o AS (
  SELECT *, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS d, 'R' || o_orderkey AS r,
    {_both(_ORDERS, "row", status="o_orderstatus")}, {_both(_ORDERS, "x", status="'X'")}
  FROM orders)"""
_CH = """ch AS (
  SELECT *, o_orderkey * 10 AS scn, 'c' AS op, NULL AS bid, row_id AS aid,
    NULL AS bimg, row_img AS aimg, NULL AS bfull, row_full AS afull FROM o
  UNION ALL SELECT *, o_orderkey * 10 + 1, 'u', row_id, x_id, row_img, x_img, row_full, x_full
    FROM o WHERE o_orderstatus = 'F'
  UNION ALL SELECT *, o_orderkey * 10 + 1, 'u', row_id, row_id, row_img, row_img, row_full, row_full
    FROM o WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
  UNION ALL SELECT *, o_orderkey * 10 + 2, 'd', x_id, NULL, x_img, NULL, x_full, NULL
    FROM o WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  UNION ALL SELECT *, o_orderkey * 10 + 3, 'ddl', NULL, NULL, NULL, NULL, NULL, NULL
    FROM o WHERE day(o_orderdate) = 1)"""


def _split(first: str = "d") -> str:
    """Changes after the split, with the id each carries."""
    d, c = (0, 1) if first == "d" else (1, 0)
    return f"""sp AS (
  SELECT *, 0 AS seq, op AS sop, coalesce(aid, bid) AS id, r AS srid, bfull AS sbefore, afull AS safter
    FROM ch WHERE op IN ('c', 'd')
  UNION ALL SELECT *, {d}, 'd', bid, NULL, bfull, NULL FROM ch WHERE op = 'u'
  UNION ALL SELECT *, {c}, 'c', aid, NULL, NULL, afull FROM ch WHERE op = 'u')"""


_LATEST = "QUALIFY row_number() OVER (PARTITION BY id ORDER BY scn DESC, seq DESC) = 1"


def _orders_state(first: str = "d", where: str = "true") -> str:
    return f"""WITH {_O}, {_CH}, {_split(first)},
last AS (SELECT * FROM sp {_LATEST})
SELECT id AS row_id, o_orderkey, o_custkey::varchar AS o_custkey,
  CASE WHEN id = x_id THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice::decimal(15,2)::varchar AS o_totalprice, o_orderdate::date::varchar AS o_orderdate, o_orderpriority
FROM last WHERE sop = 'c' AND {where}"""


_C = f"""cu AS (
  SELECT *, c_custkey * 10 AS scn0, {_both(_CUSTOMER, "row", segment="c_mktsegment")},
    {_both(_CUSTOMER, "m", segment="'GARDEN'")} FROM customer)"""
_CH_C = """cc AS (
  SELECT scn0 AS scn, 'c' AS op, NULL AS bimg, row_img AS aimg, NULL AS bid, row_id AS aid,
    NULL AS bfull, row_full AS afull FROM cu
  UNION ALL SELECT scn0 + 1, 'u', row_img, m_img, row_id, m_id, row_full, m_full FROM cu WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT scn0 + 1, 'd', row_img, NULL, row_id, NULL, row_full, NULL FROM cu WHERE c_mktsegment = 'AUTOMOBILE')"""

_PROPS_TEXT = "'{k=' || json_extract_string(props, '$.k') || '}'"
_PROPS_JSON = "'{\"k\":' || json_extract_string(props, '$.k') || '}'"
_EVENT_ID = _hash(_EVENTS, value="value", props=_PROPS_TEXT)
_EVENT_TWICE_ID = _hash(_EVENTS, value="value * 2", props=_PROPS_TEXT)

_DAMAGE = """bad AS (
  SELECT *, CASE
    WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'bad_json'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'empty'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'unknown_key'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'missing_image'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'bad_number'
    WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'missing_payload'
    WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'missing_op'
    WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN 'image_not_object'
  END AS reason FROM orders)"""

_CLASS = "['java.lang.String','java.math.BigDecimal','java.sql.Timestamp','oracle.sql.TIMESTAMP','oracle.sql.TIMESTAMPTZ','java.lang.Float','java.lang.Double','oracle.jdbc.OracleClob','oracle.jdbc.OracleBlob','oracle.jdbc.OracleNClob','oracle.sql.INTERVALYM','oracle.sql.INTERVALDS','[B','java.lang.Long','vendor.TimestampLike']"
_DICT = f"""di AS (
  SELECT 'OWN' || (p_partkey // 1600) AS owner, 'T_' || (p_partkey // 16) AS table_name,
    (p_partkey - p_partkey // 16 * 16 + 1)::integer AS pos,
    upper(replace(p_name, ' ', '_') || '_' || p_partkey) AS column_name,
    ({_CLASS})[(p_size * 15) // 51 + 1] AS class_name, p_size - 5 AS prec, (length(p_name) - 9)::integer AS sc
  FROM part)"""


def _type(native: bool) -> str:
    return f"""CASE class_name
    WHEN 'java.math.BigDecimal' THEN CASE WHEN prec > 0 AND prec <= 38 AND sc >= 0 AND sc <= prec
      THEN 'DECIMAL(' || prec || ',' || sc || ')' ELSE 'DECIMAL(38,10)' END
    WHEN 'java.sql.Timestamp' THEN '{"TIMESTAMP_NTZ" if native else "DATE"}'
    WHEN 'oracle.sql.TIMESTAMP' THEN 'TIMESTAMP_NTZ' WHEN 'oracle.sql.TIMESTAMPTZ' THEN 'TIMESTAMP_NTZ'
    WHEN 'vendor.TimestampLike' THEN 'TIMESTAMP_NTZ'
    WHEN 'java.lang.Float' THEN 'FLOAT' WHEN 'java.lang.Double' THEN 'DOUBLE'
    WHEN 'oracle.jdbc.OracleBlob' THEN '{"BINARY" if native else "STRING"}'
    WHEN 'oracle.sql.INTERVALYM' THEN '{"INTERVAL YEAR TO MONTH" if native else "TIMESTAMP_NTZ"}'
    WHEN 'oracle.sql.INTERVALDS' THEN '{"INTERVAL DAY TO SECOND" if native else "TIMESTAMP_NTZ"}'
    WHEN '[B' THEN 'BINARY' ELSE 'STRING' END"""


# The masking rules as the studied jobs apply them, in order.
_MASKS = (
    ('"password"[ ]*:[ ]*"[^"]+"', '"password": "LOG-REDACTED"', "gi"),
    (r'password[:=][^ "\\]+', "password=LOG-REDACTED", "gi"),
    (r'passwd[:=][^ "\\]+', "passwd=LOG-REDACTED", "gi"),
    (r'pass[:=][^ "\\]+', "pass=LOG-REDACTED", "gi"),
    (r'PASSWORD,[^"\\]+', "PASSWORD, LOG-REDACTED", "gi"),
    (r'secret[:=][^ "\\]+', "secret=LOG-REDACTED", "gi"),
    (r"\d{4}[^\w:]\d{4}[^\w:]\d{4}[^\w:]\d{4}", "XXXX-XXXX-XXXX-XXXX", "g"),
    (r"\d{3}[^\w:]\d{2}[^\w:]\d{4}", "XXX-XX-XXXX", "g"),
)


def _redact(text: str) -> str:
    for search, replacement, flags in _MASKS:
        text = f"regexp_replace({text}, '{search}', '{replacement}', '{flags}')"
    return text


_CARD = "lpad(c_custkey::varchar, 16, '7')"
_LOG_LINE = f"""('login ' || c_name || ' PassWord=' || c_mktsegment || ' {{"password" : "' || c_name || '"}} passwd:'
  || c_custkey || ' pass=' || c_name || ' Secret=' || c_acctbal || ' card ' || substr({_CARD}, 1, 4) || '-'
  || substr({_CARD}, 5, 4) || '-' || substr({_CARD}, 9, 4) || '-' || substr({_CARD}, 13, 4) || ' ssn '
  || substr({_CARD}, 8, 3) || '-' || substr({_CARD}, 11, 2) || '-' || substr({_CARD}, 13, 4)
  || ' IDENTIFIED BY password,' || c_name || '" done')"""

_SCORE = """CASE WHEN lang = 'de' THEN 'Request failed: sentence id is null'
    WHEN length(text) < 200 THEN 'Request failed: sentence too short'
    WHEN length(text) > 6000 THEN 'Error: 413'
    ELSE '{"sentence_id": "' || doc_id || '", "label": "' || CASE WHEN length(text) >= 2000 THEN 'long' ELSE 'short' END
      || '", "chars": ' || length(text) || '}' END"""

_TOPIC = "target-orcl-dds-orders"
_VALUE = """'{"op":"' || sop || '","schema":{"owner":"DDS","table":"ORDERS"},"row":1,"rid":'
    || coalesce('"' || srid || '"', 'null') || ',"before":' || coalesce(sbefore, 'null') || ',"after":'
    || coalesce(safter, 'null') || ',"sql":null}'"""

_LINEITEM_STATE = f"""WITH li AS (
  SELECT *, {_hash(_LINEITEM, linestatus="l_linestatus")} AS row_id,
    {_hash(_LINEITEM, linestatus="'X'")} AS x_id FROM lineitem),
sp AS (
  SELECT *, 1 AS scn, 0 AS seq, 'c' AS op, row_id AS id, l_linestatus AS st FROM li
  UNION ALL SELECT *, 2, 0, 'd', row_id, NULL FROM li WHERE l_returnflag = 'R'
  UNION ALL SELECT *, 2, 1, 'c', x_id, 'X' FROM li WHERE l_returnflag = 'R'
  UNION ALL SELECT *, 3, 0, 'd', row_id, NULL FROM li WHERE l_returnflag = 'A'),
last AS (SELECT * FROM sp {_LATEST})
SELECT id AS auto_md5_id, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, st AS l_linestatus, l_shipdate::date::varchar AS l_shipdate FROM last WHERE op = 'c'"""

# The same lines as often as the feed loads them: one of the returned is closed, one of the accepted goes.
_LINEITEM_MULTISET = f"""WITH li AS (
  SELECT *, {_hash(_LINEITEM, linestatus="l_linestatus")} AS row_id, {_hash(_LINEITEM, linestatus="'X'")} AS x_id,
    1 + round(l_tax * 100)::bigint % 3 AS times FROM lineitem),
n AS (
  SELECT *, row_id AS id, l_linestatus AS st, times - CASE WHEN l_returnflag IN ('R', 'A') THEN 1 ELSE 0 END AS copies FROM li
  UNION ALL SELECT *, x_id, 'X', 1 FROM li WHERE l_returnflag = 'R')
SELECT id AS auto_md5_id, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, st AS l_linestatus, l_shipdate::date::varchar AS l_shipdate
FROM (SELECT *, unnest(range(copies)) FROM n WHERE copies > 0)"""

ORACLE: dict[str, str] = {
    "current_multiset": _LINEITEM_MULTISET,
    "envelope_parse": f"""WITH {_O}, {_CH}
SELECT scn, d AS tms, '1.2.3' AS xid, op, 'DDS' AS owner, 'ORDERS' AS table_name, 1 AS row_no, r AS rid,
  bimg AS before, aimg AS after,
  CASE WHEN op = 'ddl' THEN 'ALTER TABLE "ORDERS" ADD C' || o_orderkey END AS sql FROM ch""",
    "bad_input_quarantine": f"""WITH {_DAMAGE}
SELECT o_orderkey * 10 + 5 AS pos, reason FROM bad WHERE reason IS NOT NULL""",
    "bad_input_dummy": f"""WITH {_O}, {_CH}, {_DAMAGE}
SELECT scn AS pos, op, 'DDS' AS owner, 'ORDERS' AS table_name, 1 AS row_no, r AS rid, md5(aimg) AS after_hash FROM ch
UNION ALL
SELECT o_orderkey * 10 + 5, 'c', 'test', 'ICE_DEMO', 1, 'AAAWAgAAEAAACRmAAB', md5('{{"C1":1}}')
FROM bad WHERE reason IN ('empty', 'bad_json', 'unknown_key', 'bad_number')""",
    "payload_projection": f"""WITH {_C}, {_CH_C}
SELECT op, 'CUSTOMER' AS table_name, bimg AS before, aimg AS after, scn FROM cc""",
    "ddl_filtered": f"WITH {_O}, {_CH} SELECT scn, op FROM ch WHERE op <> 'ddl'",
    "op_counts": f"""WITH {_O}, {_CH}, {_split()}
SELECT sop AS op, seq, count(*) AS messages FROM sp GROUP BY ALL""",
    "row_md5_insert": f"WITH {_O}, {_CH} SELECT scn, aid AS after_id, afull AS after FROM ch WHERE op = 'c'",
    "row_md5_update": f"""WITH {_O}, {_CH}
SELECT scn, bid AS before_id, aid AS after_id, bfull AS before, afull AS after FROM ch WHERE op = 'u'""",
    "row_md5_delete": f"""WITH {_O}, {_CH}
SELECT scn, bid AS before_id, bfull AS before, afull AS after FROM ch WHERE op = 'd'""",
    "row_md5_nested": f"""SELECT event_id * 10 AS scn, {_EVENT_ID} AS after_id,
  {_json(_EVENTS, _EVENT_ID, value="value", props=_PROPS_JSON)} AS after FROM events""",
    "op_passthrough": f"""WITH {_O}, {_CH}
SELECT scn, NULL::varchar AS before_id, NULL::varchar AS after_id, r AS rid,
  'ALTER TABLE "ORDERS" ADD C' || o_orderkey AS sql FROM ch WHERE op = 'ddl'""",
    "split_rows": f"""WITH {_O}, {_CH}, {_split()}
SELECT scn, seq, sop AS op, srid AS rid, id AS row_id FROM sp""",
    "target_json": f"""WITH {_O}, {_CH}, {_split()}
SELECT '{_TOPIC}' AS topic, id AS key, {_VALUE} AS value, scn, seq FROM sp""",
    "changelog_decode": f"""WITH {_O}, {_CH}, {_split()}
SELECT scn, seq * 2 AS seq, CASE sop WHEN 'c' THEN '+I' ELSE '-D' END AS kind, id AS row_id FROM sp""",
    "changelog_decode_unsplit": f"""WITH {_C}, {_CH_C}
SELECT scn, 0 AS seq, CASE op WHEN 'c' THEN '+I' WHEN 'd' THEN '-D' ELSE '-U' END AS kind,
  md5(CASE op WHEN 'c' THEN aimg ELSE bimg END) AS image_hash FROM cc
UNION ALL SELECT scn, 1, '+U', md5(aimg) FROM cc WHERE op = 'u'""",
    "current_state": _orders_state(),
    "current_state_create_first": _orders_state("c"),
    "lineitem_state": _LINEITEM_STATE,
    "null_key_drop": f"""WITH {_O}, {_CH}, {_split()}
SELECT scn AS pos, seq, id AS row_id FROM sp""",
    "typed_rows": f"""WITH {_O}, {_CH}, {_split()}
SELECT scn, seq, o_orderkey::varchar AS o_orderkey,
  CASE WHEN o_totalprice < 9999.995 THEN o_totalprice::decimal(6,2)::varchar END AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, NULL::double AS o_orderstatus, o_orderpriority,
  1 + CASE WHEN o_totalprice < 9999.995 THEN 0 ELSE 1 END AS bad_cells FROM sp WHERE sop = 'c'""",
    "typed_exact_numbers": """WITH o AS (
  SELECT o_orderkey, lpad(o_orderkey::varchar, 9, '7') AS k, lpad(o_custkey::varchar, 9, '3') AS c FROM orders)
SELECT o_orderkey, '1' || k || c || k || c || '1' AS big, k || c || '.' || lpad((o_orderkey % 100)::varchar, 2, '0') AS money,
  '-' || k || '.' || c || '123456789' AS fine, ('5' || c || '.' || k)::decimal(30,9)::decimal(15,2)::varchar AS cut,
  NULL::varchar AS huge, 1 AS bad_cells, 1 AS lossy_cells FROM o""",
    "batch_scan": _orders_state(),
    "current_bucketed": _orders_state(),
    "filtered_scan": _orders_state(where="o_orderpriority = '2-HIGH'"),
    "matching_files": f"""WITH {_O}, {_CH}, {_split()}, last AS (SELECT * FROM sp {_LATEST})
SELECT count(*) AS matching_rows, 0 AS files_missed, 0 AS files_too_many FROM last WHERE sop = 'c' AND id = x_id""",
    "filtered_scan_own_id": """SELECT CASE o_orderstatus WHEN 'P' THEN 'P' ELSE 'X' END AS asked,
  o_orderkey::varchar AS row_id, CASE o_orderstatus WHEN 'P' THEN 'P' ELSE 'X' END AS o_orderstatus
FROM orders WHERE o_orderstatus IN ('F', 'P')""",
    "bad_cells_counted": f"""WITH {_O}, {_CH}, {_split()}, last AS (SELECT * FROM sp {_LATEST})
SELECT 'load' AS run, 0 AS batch, count(*) AS changes,
  sum(CASE WHEN sop = 'd' THEN 0 WHEN o_totalprice < 9999.995 THEN 1 ELSE 2 END) AS bad_cells FROM last""",
    "layout_partitioned": "SELECT c_mktsegment, c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
    "layout_buckets": "SELECT o_orderkey, o_custkey, true AS in_bucket FROM orders",
    "compaction": _orders_state(),
    "compaction_packed": f"SELECT *, true AS fewer_files FROM ({_orders_state()})",
    "deletes_retired": f"""WITH {_O}, {_CH}, {_split()}, last AS (SELECT * FROM sp {_LATEST})
SELECT id AS row_id, sop AS op, scn, true AS refused, true AS stated FROM last
WHERE sop = 'c' OR scn >= (SELECT max(o_orderkey) FROM orders) * 5""",
    "planned_files": f"""WITH {_O}, {_CH}, {_split()},
m AS (SELECT max(o_orderkey) // 2 AS middle FROM orders),
last AS (SELECT * FROM sp, m QUALIFY row_number() OVER (PARTITION BY id, scn < middle * 10 ORDER BY scn DESC, seq DESC) = 1)
SELECT count(*) AS matching_rows, 0 AS files_missed, true AS half_left_out FROM last
WHERE sop = 'c' AND o_orderkey <= middle // 2""",
    "compaction_some_buckets": _orders_state(),
    "compaction_retried": f"""SELECT *, unnest(['old', 'new']) AS read_from, 'PATH_ALREADY_EXISTS' AS second
FROM ({_orders_state()})""",
    "lineitem_sync": _LINEITEM_STATE,
    "text_sync": _orders_state(),
    "normalise_both_outputs": f"""WITH {_O}, {_CH}, {_split()}, {_DAMAGE}
SELECT scn AS pos, seq, id AS what FROM sp
UNION ALL SELECT o_orderkey * 10 + 5, -1, reason FROM bad WHERE reason IS NOT NULL""",
    "stream_incremental_compacted": f"""WITH {_O}, {_CH}, {_split()}, last AS (SELECT * FROM sp {_LATEST})
SELECT unnest(['early', 'late']) AS reader, id AS row_id, scn FROM last WHERE sop = 'c'""",
    "plan_from_dictionary": """WITH v AS (
  SELECT *, (p_size * 15) // 51 AS kind FROM part)
SELECT 'OWN' || (p_partkey // 1600) AS owner, 'T_' || (p_partkey // 16) AS table_name,
  'ice_orcl_own' || (p_partkey // 1600) || '_t_' || (p_partkey // 16) AS keyed_table,
  (p_partkey - p_partkey // 16 * 16 + 1)::integer AS pos,
  upper(replace(p_name, ' ', '_') || '_' || p_partkey) AS column_name,
  CASE kind WHEN 1 THEN CASE WHEN p_size > 5 AND p_size - 5 >= 2 THEN 'DECIMAL(' || (p_size - 5) || ',2)' ELSE 'DECIMAL(38,10)' END
    WHEN 2 THEN 'TIMESTAMP_NTZ' WHEN 3 THEN 'TIMESTAMP_NTZ' WHEN 4 THEN 'TIMESTAMP_NTZ' WHEN 5 THEN 'FLOAT'
    WHEN 6 THEN 'DOUBLE' WHEN 8 THEN 'BINARY' WHEN 10 THEN 'INTERVAL YEAR TO MONTH'
    WHEN 11 THEN 'INTERVAL DAY TO SECOND' WHEN 12 THEN 'BINARY' WHEN 13 THEN 'DECIMAL(38,10)' ELSE 'STRING' END AS spark_type
FROM v""",
    "created_tables": _orders_state(),
    "allow_list_per_owner": """SELECT * FROM (
  SELECT 'orcl-' || CASE WHEN c_nationkey < 12 THEN 'dds' WHEN c_nationkey < 20 THEN 'crm' ELSE 'old' END
    || '-' || lower(c_mktsegment) AS topic, c_custkey FROM customer)
WHERE topic = 'orcl-dds-building' OR topic LIKE 'orcl-crm-%'""",
    "stream_apply": f"""WITH e AS (
  SELECT {_EVENT_ID} AS row_id, event_id, ts, user_id, event_type, value, props FROM events
  WHERE event_type NOT IN ('error', 'view')
  UNION ALL SELECT {_EVENT_TWICE_ID}, event_id, ts, user_id, event_type, value * 2, props FROM events
  WHERE event_type = 'view')
SELECT row_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value,
  {_PROPS_JSON} AS props FROM e""",
    "multi_table": f"""WITH {_O}, {_CH}, {_split()}, {_C}, last AS (SELECT * FROM sp {_LATEST})
SELECT 'ice_orcl_dds_orders' AS keyed_table, id AS row_id, o_orderkey AS source_key FROM last WHERE sop = 'c'
UNION ALL SELECT 'ice_orcl_dds_customer', CASE c_mktsegment WHEN 'BUILDING' THEN m_id ELSE row_id END, c_custkey
FROM cu WHERE c_mktsegment <> 'AUTOMOBILE'
UNION ALL SELECT 'ice_orcl_dds_supplier', {_hash(_SUPPLIER)}, s_suppkey FROM supplier""",
    "stream_incremental": f"""WITH {_O}, {_CH}, {_split()}, last AS (SELECT * FROM sp {_LATEST})
SELECT id AS row_id, scn FROM last WHERE sop = 'c'""",
    "net_changes": """WITH o AS (
  SELECT *, o_orderkey::varchar AS row_id, o_orderkey * 10 AS scn, o_orderpriority = '2-HIGH' AS high FROM orders),
n AS (
  SELECT row_id, '+I' AS kind, o_orderstatus AS st, o_custkey, scn FROM o WHERE NOT high
  UNION ALL SELECT row_id, '+I', CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END, o_custkey,
    scn + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS scn FROM o WHERE high
  UNION ALL SELECT row_id, '-D', 'F', o_custkey, scn + 2 FROM o WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  UNION ALL SELECT row_id, unnest(['-U', '+U']), unnest(['F', 'X']), o_custkey, scn + 1 FROM o
    WHERE o_orderstatus = 'F' AND NOT high AND o_orderpriority <> '1-URGENT'
  UNION ALL SELECT row_id, 'late', 'N', o_custkey, scn - 5 FROM o WHERE o_orderstatus = 'P' AND NOT high)
SELECT row_id, kind, st AS o_orderstatus, o_custkey::varchar AS o_custkey, scn FROM n""",
    "stream_relay": f"""SELECT 'copy' AS topic, '{{"scn":' || s_suppkey * 10
  || ',"payload":{{"op":"c","schema":{{"owner":"DDS","table":"SUPPLIER"}},"row":1,"after":' || {_json(_SUPPLIER)}
  || '}}}}' AS value, s_suppkey * 10 AS pos FROM supplier""",
    "text_source_sink": f"""WITH {_C}, {_CH_C}, m AS (
  SELECT op, bfull, afull FROM cc WHERE op <> 'u'
  UNION ALL SELECT 'd', bfull, NULL FROM cc WHERE op = 'u' UNION ALL SELECT 'c', NULL, afull FROM cc WHERE op = 'u')
SELECT 'target-orcl-dds-customer' AS topic, '{{"op":"' || op
  || '","schema":{{"owner":"DDS","table":"CUSTOMER"}},"row":1,"rid":null,"before":' || coalesce(bfull, 'null')
  || ',"after":' || coalesce(afull, 'null') || ',"sql":null}}' AS value FROM m""",
    "stream_quarantine": f"""WITH {_DAMAGE}
SELECT 'orcl-dds-orders' AS topic, o_orderkey * 10 + 5 AS pos, reason FROM bad WHERE reason IS NOT NULL""",
    "type_map": f"""WITH {_DICT}
SELECT owner, table_name, pos, column_name, {_type(False)} AS spark_type FROM di""",
    "type_map_native": f"""WITH {_DICT}
SELECT owner, table_name, pos, class_name, {_type(True)} AS spark_type FROM di""",
    "table_plan": f"""WITH {_DICT}
SELECT owner, table_name, count(*)::integer AS n_columns,
  'CREATE TABLE IF NOT EXISTS lake.orcl.ice_orcl_' || lower(owner) || '_' || lower(table_name)
  || ' (`AUTO_MD5_ID` STRING, ' || string_agg('`' || column_name || '` ' || {_type(False)}, ', ' ORDER BY pos)
  || ') USING iceberg TBLPROPERTIES (''format-version''=''2'', ''write.upsert.enabled''=''true'')' AS ddl
FROM di GROUP BY owner, table_name""",
    "topic_names": f"""WITH {_DICT}, t AS (SELECT DISTINCT lower(owner) AS o, lower(table_name) AS t FROM di)
SELECT 'orcl-' || o || '-' || t AS source_topic, 'target-orcl-' || o || '-' || t AS target_topic,
  'kafka_orcl_' || o || '_' || t AS change_table, 'ice_orcl_' || o || '_' || t AS keyed_table FROM t""",
    "list_tables": f"WITH {_DICT} SELECT DISTINCT owner, table_name FROM di ORDER BY owner, table_name",
    "probe_columns": f"""WITH {_DICT}
SELECT owner, table_name, pos, column_name, class_name, prec, sc FROM di ORDER BY owner, table_name, pos""",
    "allow_list": """SELECT 'orcl-dds-' || lower(c_mktsegment) AS topic, c_custkey FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "allow_list_table": """SELECT 'Nation_' || c_nationkey AS table_name, c_custkey FROM customer
WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""",
    "score_requests": """SELECT doc_id AS pos, doc_id::varchar AS sentence_id, md5(text) AS sentence_hash
FROM documents WHERE lang <> 'de'""",
    "score_results": f"""SELECT doc_id AS pos,
  CASE WHEN lang = 'de' OR length(text) < 200 THEN NULL WHEN length(text) > 6000 THEN 413 ELSE 200 END AS status,
  CASE WHEN lang = 'de' THEN 'sentence id is null' WHEN length(text) < 200 THEN 'sentence too short' END AS error,
  {_SCORE} AS output FROM documents""",
    "score_stream": f"""SELECT 'predict_sentence_result_topic' AS topic, {_SCORE} AS value, doc_id AS pos FROM documents""",
    "tag_window_counts": """SELECT time_bucket(INTERVAL '10 minutes', ts)::varchar AS window_start,
  event_type AS tag, count(*) AS messages FROM events GROUP BY ALL""",
    "redacted_text": f"SELECT c_custkey, {_redact(_LOG_LINE)} AS line FROM customer",
    "redacted_documents": f"""WITH d AS (
  SELECT doc_id, {_redact("(text || ' secret=' || source || ' pass:' || lang)")} AS t FROM documents)
SELECT doc_id, md5(t) AS text_hash, length(t)::integer AS chars FROM d""",
}
ORACLE["multi_table_log"] = ORACLE["multi_table"]
ORACLE["score_concurrent"] = ORACLE["score_results"]
ORACLE["stream_counters"] = f"""WITH {_O}, {_CH}, {_DAMAGE}
SELECT 'read' AS metric, (SELECT count(*) FROM ch) + (SELECT count(*) FROM bad WHERE reason IS NOT NULL) AS n
UNION ALL SELECT 'bad_' || reason, count(*) FROM bad WHERE reason IS NOT NULL GROUP BY reason"""
# A stream that starts at the latest message skips the first third: it was there before.
ORACLE["log_from_latest"] = f"""WITH r AS ({ORACLE["stream_relay"]})
SELECT 'earliest' AS topic, value, pos FROM r UNION ALL SELECT 'latest', value, pos FROM r WHERE pos // 10 % 3 > 0"""
ORACLE["tag_hour_statistics"] = """SELECT time_bucket(INTERVAL '1 hour', ts)::varchar AS window_start, event_type AS tag,
  count(*) AS messages, true AS distinct_near, true AS median_near, true AS high_near, true AS top_exact FROM events GROUP BY ALL"""
ORACLE["tag_statistics_stream"] = ORACLE["tag_hour_statistics"]
ORACLE["redacted_by_file"] = ORACLE["redacted_text"]
