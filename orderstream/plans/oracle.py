"""SQL over the given tables for every registered query, written without JSON or buckets."""

from __future__ import annotations

from orderstream.plans.tables import KEY_CITIES, RANGE_GAP, RANGE_WIDTH

_NUMBER = "((o_custkey % 2147483648) * 2654435761 + (o_orderkey % 2147483648) * 40503) % 4294967296"


def _dotted(number: str) -> str:
    octets = (f"(({number}) // {unit}) % 256" for unit in (16777216, 65536, 256, 1))
    return " || '.' || ".join(f"CAST({octet} AS VARCHAR)" for octet in octets)


# n: orders as text fields and address number; d: the dictionary; e: orders with their region.
_ORDERS = f"""
n AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, {_NUMBER} AS ipn,
    CAST(o_orderkey AS VARCHAR) AS "orderId", CAST(o_custkey AS VARCHAR) AS "userId",
    strftime(o_orderdate, '%Y-%m-%d%H:%M:%S.%g') AS "orderTime",
    CASE WHEN o_orderkey % 97 = 0 THEN 'unknown' ELSE {_dotted(_NUMBER)} END AS ip,
    CAST(o_totalprice AS VARCHAR) AS "orderMoney",
    CASE o_orderstatus WHEN 'O' THEN '0' WHEN 'P' THEN '1' ELSE '2' END AS "orderStatus"
  FROM orders)"""

_DICTIONARY = f"""
d AS (
  SELECT k * {RANGE_WIDTH} AS lo, (k + 1) * {RANGE_WIDTH} - 1 - {RANGE_GAP} AS hi,
    n_name AS province, 'CITY_' || CAST(k AS VARCHAR) AS city
  FROM (SELECT n_name, CAST(n_nationkey AS BIGINT) * 4 + i AS k
        FROM nation, (VALUES (0), (1), (2), (3)) AS f(i)))"""

_LOCATED = f"""{_ORDERS}, {_DICTIONARY},
e AS (
  SELECT n.*, d.province, d.city
  FROM n LEFT JOIN d ON n.ip <> 'unknown' AND n.ipn BETWEEN d.lo AND d.hi)"""

_CITY_LIST = ", ".join(f"'{city}'" for city in KEY_CITIES)
_SUM = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"

# Rank of an order among those of its city, newest first.
_NEWEST = f"""{_LOCATED},
r AS (
  SELECT *, row_number() OVER (
    PARTITION BY city ORDER BY o_orderdate DESC, o_custkey % 3 DESC, o_orderkey DESC) AS age
  FROM e WHERE city IS NOT NULL)"""

_CHART = f"""{_NEWEST},
c AS (
  SELECT city, province, CASE WHEN "orderStatus" = '2' THEN 'n/a' ELSE "orderMoney" END AS money
  FROM r WHERE age = 1)"""

_ETL_COLUMNS = '"orderId", "userId", "orderTime", province, city, "orderMoney", "orderStatus"'

# The properties text of every event, and a noise line by number of shape.
_NOISE = r"""
noise AS (
  SELECT 'props' AS source, event_id, props AS value FROM events
  UNION ALL SELECT 'noise', event_id, CASE event_id % 11
    WHEN 0 THEN NULL WHEN 1 THEN ',' WHEN 2 THEN ',,,' WHEN 3 THEN ' , '
    WHEN 4 THEN chr(9) || ',' || chr(10) WHEN 5 THEN '' WHEN 6 THEN ' ' WHEN 7 THEN ', ,'
    WHEN 8 THEN ',a' WHEN 9 THEN 'a,,' ELSE '{bad' END
  FROM events)"""

_ORDER_JSON = """'{"orderId":"' || "orderId" || '","userId":"' || "userId" || '","orderTime":"' ||
  "orderTime" || '","ip":"' || ip || '","orderMoney":' || "orderMoney" || ',"orderStatus":' ||
  "orderStatus" || '}'"""

_ETL_JSON = """'{"orderId":"' || "orderId" || '","userId":"' || "userId" || '","orderTime":"' ||
  "orderTime" || '"' || coalesce(',"province":"' || province || '"', '') ||
  coalesce(',"city":"' || city || '"', '') || ',"orderMoney":"' || "orderMoney" ||
  '","orderStatus":"' || "orderStatus" || '"}'"""


def _sum_where(condition: str) -> str:
    amount = "sum(CAST(o_totalprice AS DECIMAL(18,2)))"
    return f"CAST({amount} FILTER (WHERE {condition}) AS DOUBLE)"


def _city_columns(cities: tuple[str, ...]) -> str:
    return ", ".join(f"{_sum_where(f"city = '{city}'")} AS \"{city}\"" for city in cities)


_ALL_CITIES = tuple(f"CITY_{n}" for n in range(100))

_TOTAL = f"SELECT {_SUM} AS total_amt FROM orders"
_BY_PROVINCE = f"WITH {_LOCATED} SELECT province, {_SUM} AS total_amt FROM e GROUP BY province"
_BY_CITY = f"WITH {_LOCATED} SELECT city, {_SUM} AS total_amt FROM e GROUP BY city"
_ANY_DOUBLES = f"""WITH {_LOCATED}, c AS (
  SELECT province, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM e)
SELECT province, CAST(sum(CASE WHEN cents % 2 = 1 THEN -cents ELSE cents END) AS DOUBLE) / 1024 AS total_amt
FROM c GROUP BY province"""
_KEY_ROWS = f"""WITH {_LOCATED}
SELECT o_totalprice AS money, province, city FROM e WHERE city IN ({_CITY_LIST})"""
_KEY_AMOUNT = f"""WITH {_LOCATED}
SELECT city, {_SUM} AS total_amt FROM e WHERE city IN ({_CITY_LIST}) GROUP BY city"""
_KEY_LATEST = f"""WITH {_NEWEST}
SELECT city, o_totalprice AS money, province FROM r WHERE age = 1 AND city IN ({_CITY_LIST})"""
_ETL = f"WITH {_LOCATED} SELECT {_ETL_COLUMNS} FROM e"
_ETL_OPEN = f"""WITH {_LOCATED} SELECT {_ETL_COLUMNS} FROM e WHERE "orderStatus" = '0'"""
_GEO = f"""WITH {_LOCATED} SELECT "orderId", ip, province, city FROM e"""

# Every sum as it is stored: key, field, amount.
_ALL_SUMS = f"""
SELECT 'orders:money:total' AS key, 'global' AS field, {_SUM} AS amount, NULL::VARCHAR AS text FROM e
UNION ALL SELECT 'orders:provincemoney:' || coalesce(province, 'null'), 'total_amt', {_SUM}, NULL
  FROM e GROUP BY province
UNION ALL SELECT 'orders:citymoney:global', coalesce(city, 'null'), {_SUM}, NULL FROM e GROUP BY city
UNION ALL SELECT 'orders:keycityamount:' || city, 'total_amt', {_SUM}, NULL
  FROM e WHERE city IN ({_CITY_LIST}) GROUP BY city"""

# Counted over all orders and noise lines: only lines of commas, or none, are dropped.
_COUNTS = f"""WITH {_LOCATED}, {_NOISE},
cut AS (SELECT value, trim(value, ' ' || chr(9) || chr(10)) AS core FROM noise),
junk AS (
  SELECT count(*) AS lines,
    count(*) FILTER (WHERE value IS NULL OR (core <> '' AND replace(core, ',', '') = '')) AS dropped
  FROM cut),
found AS (
  SELECT count(*) AS lines, count(*) FILTER (WHERE province IS NULL AND city IS NULL) AS unknown_address,
    count(*) FILTER (WHERE o_orderkey % 89 = 0) AS no_number
  FROM e)
SELECT found.lines + junk.lines AS lines, dropped, junk.lines - dropped AS unparsed,
  unknown_address, no_number
FROM found, junk"""

ORACLE: dict[str, str] = {
    "message_filter": f"""WITH {_ORDERS}, {_NOISE},
lines AS (
  SELECT 'orders' AS source, o_orderkey AS line_id, {_ORDER_JSON} AS value FROM n
  UNION ALL SELECT source, event_id, value FROM noise),
cut AS (SELECT *, trim(value, ' ' || chr(9) || chr(10)) AS core FROM lines)
SELECT source, line_id, value FROM cut
WHERE value IS NOT NULL AND (core = '' OR replace(core, ',', '') <> '')""",
    "order_fields": f"""WITH {_ORDERS}
SELECT "orderId", "userId", "orderTime", ip, "orderMoney", "orderStatus" FROM n""",
    "order_envelope": f"WITH {_ORDERS} SELECT {_ORDER_JSON} AS value FROM n",
    "order_timestamps": """SELECT CAST(o_orderkey AS VARCHAR) AS "orderId",
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at FROM orders""",
    "order_status_label": """SELECT CAST(o_orderkey AS VARCHAR) AS "orderId",
  CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'cancelled' ELSE 'closed' END AS status
FROM orders""",
    "order_time_format": """SELECT event_id, strftime(ts, '%Y-%m-%d%H:%M:%S.%g') AS order_time,
  strftime(ts, '%Y%m%d%H%M%S%g') AS id_time FROM events""",
    "order_id_format": """SELECT event_id,
  strftime(ts, '%Y%m%d%H%M%S%g') ||
    CASE WHEN event_id < 1000000 THEN lpad(CAST(event_id AS VARCHAR), 6, '0')
         ELSE CAST(event_id AS VARCHAR) END AS order_id,
  CAST(user_id % 5 + 1 AS VARCHAR) || lpad(CAST(user_id % 1000 AS VARCHAR), 8, '0') AS user_id,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS money
FROM events""",
    "int_to_ipv4": f"SELECT o_orderkey, {_dotted(_NUMBER)} AS ip FROM orders",
    "ipv4_to_long": f"""SELECT o_orderkey,
  CASE WHEN o_orderkey % 16 > 6 THEN {_NUMBER} END AS ip_number FROM orders""",
    "region_fields": """SELECT c_custkey,
  CASE WHEN c_custkey % 8 NOT IN (0, 2) THEN c_mktsegment END AS province,
  CASE WHEN c_custkey % 8 NOT IN (0, 2) THEN c_name END AS city FROM customer""",
    "geo_lookup": _GEO,
    "geo_lookup_shuffled": _GEO,
    "geo_lookup_hot": f"""WITH h AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN {_NUMBER} ELSE o_orderkey % 65536 END AS number
  FROM orders),
{_DICTIONARY}
SELECT o_orderkey, {_dotted("number")} AS ip, province, city
FROM h LEFT JOIN d ON number BETWEEN lo AND hi""",
    "geo_lookup_crowded": f"""WITH l AS (
  SELECT l_orderkey, l_linenumber, l_suppkey * 4 + l_orderkey % 4 AS number FROM lineitem)
SELECT l_orderkey, l_linenumber, {_dotted("number")} AS ip,
  'NATION_' || CAST(s_nationkey AS VARCHAR) AS province, s_name AS city
FROM l LEFT JOIN supplier ON number // 4 = s_suppkey AND number % 4 <= s_suppkey % 4""",
    "order_etl": _ETL,
    "order_etl_open": _ETL_OPEN,
    "etl_envelope": f"WITH {_LOCATED} SELECT {_ETL_JSON} AS value FROM e",
    "report_rows": f"WITH {_LOCATED} SELECT o_totalprice AS money, province, city FROM e",
    "amt_total": _TOTAL,
    "amt_by_province": _BY_PROVINCE,
    "amt_by_city": _BY_CITY,
    "amt_any_doubles": _ANY_DOUBLES,
    "key_city_rows": _KEY_ROWS,
    "key_city_amount": _KEY_AMOUNT,
    "key_city_latest": _KEY_LATEST,
    "pivot_total": f"""SELECT {_SUM} AS "global", 'total' AS type FROM orders""",
    "pivot_city": f"""WITH {_LOCATED}
SELECT 'global' AS total, {_city_columns(KEY_CITIES)} FROM e""",
    "pivot_city_map": f"""WITH {_LOCATED}
SELECT 'orders:citymoney:global' AS key, coalesce(city, 'null') AS field, {_SUM} AS amount
FROM e GROUP BY city""",
    "pivot_city_found": f"""WITH {_LOCATED}
SELECT 'global' AS total, {_city_columns(_ALL_CITIES)},
  {_sum_where("city IS NULL")} AS "null" FROM e""",
    "keyed_hashes": f"""WITH {_NEWEST}, k AS (
  SELECT 'orders:citymoney:' || city AS key, "orderMoney" AS money, province
  FROM r WHERE age = 1 AND city IN ({_CITY_LIST}))
SELECT key, 'money' AS field, money AS value FROM k
UNION ALL SELECT key, 'province', province FROM k""",
    "dashboard_feed": f"""WITH {_CHART}
SELECT '销售额' AS series, province AS category,
  CAST(arg_max(money, city) AS DOUBLE) AS value
FROM c WHERE money <> 'n/a' GROUP BY province""",
    "dashboard_rejects": f"""WITH {_CHART}
SELECT city, province, money FROM c WHERE money = 'n/a'""",
    "s_order_etl": _ETL,
    "s_order_etl_shuffled": _ETL,
    "s_order_etl_open": _ETL_OPEN,
    "s_amt_total": _TOTAL,
    "s_amt_by_province": _BY_PROVINCE,
    "s_amt_by_city": _BY_CITY,
    "s_key_city_rows": _KEY_ROWS,
    "s_key_city_amount": _KEY_AMOUNT,
    "s_key_city_latest": _KEY_LATEST,
    "s_dashboard": f"""WITH {_NEWEST}
SELECT '销售额' AS series, province AS category, arg_max(o_totalprice, city) AS value
FROM r WHERE age = 1 AND city IN ({_CITY_LIST}) GROUP BY province""",
    "s_sums_together": f"""WITH {_LOCATED} {_ALL_SUMS}""",
    "s_two_jobs": f"""WITH {_NEWEST} {_ALL_SUMS}
UNION ALL SELECT 'orders:citymoney:' || city, 'money', o_totalprice, NULL
  FROM r WHERE age = 1 AND city IN ({_CITY_LIST})
UNION ALL SELECT 'orders:citymoney:' || city, 'province', NULL, province
  FROM r WHERE age = 1 AND city IN ({_CITY_LIST})""",
    "s_restart": _BY_CITY,
    # Eight segments at least, two or three of them in a batch of a third of the orders.
    "s_rate_cap": """SELECT count(*) AS input_rows, sum(o_orderkey)::BIGINT AS order_keys,
  0::BIGINT AS batches_beyond, least(count(*), 3) AS batches FROM orders""",
    "s_key_city_latest_late": _KEY_LATEST,
    "s_state_read_back": f"""WITH {_LOCATED}, sums AS (SELECT city, {_SUM} AS amount FROM e GROUP BY city)
SELECT store, city, amount AS in_state, amount AS stored
FROM sums, (VALUES ('default'), ('rocksdb')) AS s(store)""",
    "s_state_widened": f"WITH {_LOCATED} SELECT city, {_SUM} AS total_amt, 16 AS stores FROM e GROUP BY city",
    "s_start_latest": f"""WITH {_LOCATED}
SELECT province, {_SUM} AS total_amt FROM e WHERE o_custkey % 3 <> 0 GROUP BY province""",
    "s_etl_counts": _COUNTS,
    "etl_counts": _COUNTS,
}
