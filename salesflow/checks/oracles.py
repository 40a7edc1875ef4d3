"""The same results in SQL over the same tables, written for DuckDB."""

from __future__ import annotations

# Fixed value: what counts as a number, as in functions/clean.py.
NUMBER = r"'^\s*[-+]?(?:\d+(?:\.\d+)?|\.\d+)\s*$'"


def _number(text: str) -> str:
    point = f"replace({text}, ',', '.')"
    return f"CASE WHEN regexp_matches({point}, {NUMBER}) THEN TRY_CAST({point} AS DOUBLE) ELSE 0.0 END"


def _bad(text: str) -> str:
    return f"CASE WHEN NOT regexp_matches(replace({text}, ',', '.'), {NUMBER}) THEN 1 ELSE 0 END"


def _created_at(timestamp: str, key: str) -> str:
    return (
        f"CASE WHEN {key} % 5 = 0 THEN strftime({timestamp}, '%Y-%m-%d') "
        f"ELSE strftime({timestamp}, '%Y-%m-%d %H:%M:%S') END"
    )


RAW_CUSTOMERS = """
  SELECT CAST(c_custkey AS VARCHAR) customer_id, n_name city,
         CASE c_custkey % 8 WHEN 0 THEN 'false' WHEN 1 THEN '1' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'yes'
              WHEN 4 THEN 'Y' WHEN 5 THEN 't' WHEN 6 THEN '0' END is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""
CUSTOMERS = f"""
  SELECT customer_id, city, lower(is_active) IN ('1', 'true', 'yes', 'y', 't') is_active
  FROM ({RAW_CUSTOMERS})"""
ORDER_ID = "CAST(l_orderkey AS VARCHAR)"
SHIPMENT_ID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


def _raw_refunds(order_id: str) -> str:
    return f"""
  SELECT {order_id} order_id,
         CASE WHEN l_linenumber = 7 THEN 'error'
              WHEN l_linenumber = 6 THEN replace('-' || CAST(l_extendedprice AS VARCHAR), '.', ',')
              ELSE '-' || CAST(l_extendedprice AS VARCHAR) END amount,
         strftime(l_shipdate, '%Y-%m-%d') created_at
  FROM lineitem WHERE l_returnflag = 'R'"""


def _refunds(order_id: str) -> str:
    return f"SELECT order_id, {_number('amount')} amount, created_at FROM ({_raw_refunds(order_id)})"


ORDER_COLUMNS = """
         CAST(o_custkey AS VARCHAR) customer_id,
         CASE WHEN o_orderkey % 2 = 0 THEN 'web' ELSE 'app' END channel,
         CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'P' THEN 'pending' ELSE 'failed' END payment_status"""
LINES = f"""
  SELECT CAST(o_orderkey AS VARCHAR) order_id, {_created_at("o_orderdate", "o_orderkey")} created_at,
         {ORDER_COLUMNS}, l_linenumber pos, l_quantity item_qty, CAST(l_partkey AS VARCHAR) item_sku,
         CASE WHEN l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END item_unit_price
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0)
  JOIN lineitem ON o_orderkey = l_orderkey"""
PRICE_TEXT = "CAST(CASE WHEN l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END AS VARCHAR)"
NESTED = f"""
  SELECT {SHIPMENT_ID} order_id, {_created_at("l_shipdate", "l_orderkey")} created_at, {ORDER_COLUMNS},
         l_linenumber, l_suppkey, l_tax,
         CASE WHEN l_partkey % 40 = 0 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END goods_qty,
         'P' || CAST(l_partkey AS VARCHAR) goods_sku,
         CASE WHEN l_suppkey % 3 = 0 THEN replace({PRICE_TEXT}, '.', ',') ELSE {PRICE_TEXT} END goods_price
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
HEAD = "channel, created_at, customer_id, order_id, payment_status"
EXPLODED = f"""
  SELECT {HEAD}, 0 pos, goods_qty item_qty, goods_sku item_sku, goods_price item_unit_price
  FROM ({NESTED}) WHERE l_linenumber <= 5
  UNION ALL
  SELECT {HEAD}, 1, '1', 'S' || CAST(l_suppkey AS VARCHAR),
         CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR)
  FROM ({NESTED}) WHERE l_linenumber <= 5"""
EMPTY = f"SELECT {HEAD}, NULL, NULL, NULL, NULL FROM ({NESTED}) WHERE l_linenumber > 5"

NATIVE_CLEAN = "item_qty item_qty_d, item_unit_price item_unit_price_d"
TEXT_CLEAN = f"{_number('item_qty')} item_qty_d, {_number('item_unit_price')} item_unit_price_d"


def _kept(lines: str, clean: str) -> str:
    return f"""
  SELECT * FROM (SELECT *, {clean} FROM ({lines}) WHERE payment_status = 'paid')
  WHERE NOT item_unit_price_d < 0"""


def _first_lines(lines: str, clean: str) -> str:
    return f"""
  SELECT *, CAST(item_qty_d AS BIGINT) items_sold, item_qty_d * item_unit_price_d gross_revenue_eur
  FROM ({_kept(lines, clean)})
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY created_at, pos, customer_id, channel,
                             item_qty_d, item_unit_price_d) = 1"""


# one whole order per order_id: its first record, taken by the same ties as in Spark
ORDER_TOTALS = f"""
  SELECT order_id, customer_id, channel, created_at, CAST(sum(qty) AS BIGINT) items_sold,
         sum(qty * price) gross_revenue_eur
  FROM (
    SELECT order_id, customer_id, channel, created_at, qty, price FROM (
      SELECT n.*, unnest([{_number('goods_qty')}, 1.0]) qty,
             unnest([{_number('goods_price')}, CAST(CAST(round(l_tax * 100) AS INTEGER) AS DOUBLE)]) price
      FROM (SELECT * FROM ({NESTED}) WHERE payment_status = 'paid'
            QUALIFY row_number() OVER (
              PARTITION BY order_id
              ORDER BY created_at, channel, customer_id,
                       CASE WHEN l_linenumber = 6 THEN 0 WHEN l_linenumber = 7 THEN 1 ELSE 2 END,
                       goods_qty, goods_sku, goods_price, 'S' || CAST(l_suppkey AS VARCHAR),
                       CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR)) = 1) n
      WHERE l_linenumber <= 5))
  WHERE NOT price < 0
  GROUP BY order_id, customer_id, channel, created_at"""


def _sales(totals: str, order_id: str) -> str:
    return f"""
WITH cust AS ({CUSTOMERS}),
refunds_sum AS (SELECT order_id, sum(amount) refunds_eur FROM ({_refunds(order_id)}) GROUP BY order_id),
totals AS ({totals}),
orders_clean AS (
  SELECT t.order_id, t.customer_id, city, channel, left(created_at, 10) order_date, items_sold,
         gross_revenue_eur, coalesce(refunds_eur, 0.0) refunds_eur
  FROM totals t JOIN cust USING (customer_id) LEFT JOIN refunds_sum r ON t.order_id = r.order_id
  WHERE is_active),
daily AS (
  SELECT order_date AS date, city, channel, count(DISTINCT order_id) orders_count,
         count(DISTINCT customer_id) unique_customers, CAST(sum(items_sold) AS BIGINT) items_sold,
         round(sum(gross_revenue_eur), 2) gross_revenue_eur, round(sum(refunds_eur), 2) refunds_eur,
         round(sum(gross_revenue_eur) + sum(refunds_eur), 2) net_revenue_eur
  FROM orders_clean GROUP BY order_date, city, channel)"""


STAR = _sales(_first_lines(LINES, NATIVE_CLEAN), ORDER_ID)
SHIPMENTS = _sales(_first_lines(EXPLODED, TEXT_CLEAN), SHIPMENT_ID)
COUNTERS = f"""{SHIPMENTS},
paid AS (SELECT *, {TEXT_CLEAN} FROM ({EXPLODED}) WHERE payment_status = 'paid')
SELECT (SELECT count(*) FROM cust) customers_rows_raw,
       (SELECT count(*) - count(DISTINCT customer_id) FROM cust) dup_customers,
       (SELECT count(*) FROM ({_raw_refunds(SHIPMENT_ID)})) refunds_rows,
       (SELECT CAST(sum({_bad('amount')}) AS BIGINT) FROM ({_raw_refunds(SHIPMENT_ID)})) refunds_amount_non_numeric,
       (SELECT count(*) FROM ({NESTED})) orders_rows_raw,
       (SELECT count(*) FROM ({NESTED}) WHERE payment_status = 'paid') orders_rows_paid,
       CAST(0 AS BIGINT) orders_bad_date,
       (SELECT CAST(sum({_bad('item_qty')}) AS BIGINT) FROM paid) items_qty_non_numeric,
       (SELECT CAST(sum({_bad('item_unit_price')}) AS BIGINT) FROM paid) items_unit_price_non_numeric,
       (SELECT count(*) FROM paid WHERE item_unit_price_d < 0) rejected_negative_price_rows,
       (SELECT count(*) FROM orders_clean) orders_clean_rows,
       (SELECT count(*) FROM daily) daily_city_sales_rows"""
DIRTY = """
  SELECT event_id, event_type,
         CASE event_type WHEN 'error' THEN CAST(value AS VARCHAR) || ' EUR'
                         WHEN 'click' THEN replace(CAST(value AS VARCHAR), '.', ',')
                         WHEN 'view' THEN ' +' || CAST(value AS VARCHAR)
                         ELSE CAST(value AS VARCHAR) END AS value
  FROM events"""


def _debtors(how: str) -> str:
    return f"""
SELECT o_orderkey, o_custkey, debtor, c_custkey, c_name, c_acctbal
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN o_custkey END debtor FROM orders) {how} JOIN
     (SELECT *, CASE WHEN c_acctbal < 0 THEN c_custkey END in_debt FROM customer) ON debtor = in_debt"""


def _groups(table: str, key: str, value: str) -> str:
    return f"""
SELECT key, chunk, CAST(count(*) AS INTEGER) n, string_agg(CAST(value AS VARCHAR), ',' ORDER BY value) AS values
FROM (SELECT {key} AS key, {value} AS value,
             (row_number() OVER (PARTITION BY {key} ORDER BY {value}) - 1) // 1000 chunk FROM {table})
GROUP BY key, chunk"""


SUBCENT = f"""
WITH cust AS ({CUSTOMERS}),
refunds_sum AS (SELECT order_id, sum(CAST(amount AS DECIMAL(18, 4))) refund FROM ({_refunds(ORDER_ID)}) GROUP BY order_id),
first_lines AS (
  SELECT * FROM ({_kept(LINES.replace("l_quantity item_qty", "l_discount item_qty"), NATIVE_CLEAN)})
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY created_at, pos, customer_id, channel,
                             item_qty_d, item_unit_price_d) = 1),
exact AS (
  SELECT left(created_at, 10) AS date, city, channel, t.order_id, t.customer_id, CAST(trunc(item_qty_d) AS BIGINT) sold,
         CAST(item_qty_d AS DECIMAL(9, 4)) * CAST(item_unit_price_d AS DECIMAL(18, 4)) gross,
         coalesce(refund, 0) refund
  FROM first_lines t JOIN cust USING (customer_id) LEFT JOIN refunds_sum r ON t.order_id = r.order_id WHERE is_active)
SELECT date, city, channel, count(DISTINCT order_id) orders_count, count(DISTINCT customer_id) unique_customers,
       CAST(sum(sold) AS BIGINT) items_sold, CAST(round(sum(gross), 2) AS DOUBLE) gross_revenue_eur,
       CAST(round(sum(refund), 2) AS DOUBLE) refunds_eur, CAST(round(sum(gross) + sum(refund), 2) AS DOUBLE) net_revenue_eur
FROM exact GROUP BY date, city, channel"""


WORDS = r"""
SELECT word, count(*) count
FROM (SELECT unnest(regexp_split_to_array(lower(regexp_replace(text, '[^\w\s]', ' ', 'g')), '\s+')) word FROM documents)
WHERE word <> '' GROUP BY word"""


def _raw_words(table: str) -> str:
    return rf"""
SELECT word, count(*) count
FROM (SELECT unnest(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+')) word FROM {table})
WHERE word <> '' GROUP BY word"""


REFUNDS_SUM = f"SELECT order_id, round(sum(amount), 2) refunds_eur FROM ({_refunds(ORDER_ID)}) GROUP BY order_id"
ALTERED = f"""
  SELECT order_id, round(total - CASE WHEN CAST(order_id AS BIGINT) % 100 = 0 THEN 1 ELSE 0 END, 2) refunds_eur
  FROM (SELECT order_id, sum(amount) total FROM ({_refunds(ORDER_ID)}) GROUP BY order_id)"""
STAR_DAILY = f"{STAR} SELECT * FROM daily"
SHIPMENTS_DAILY = f"{SHIPMENTS} SELECT * FROM daily"
LINE_COLUMNS = "order_id, created_at, customer_id, channel, payment_status, pos, item_qty, item_sku, item_unit_price"

ORACLES = {
    "daily_city_sales": STAR_DAILY,
    "daily_decimal": STAR_DAILY,
    "daily_decimal_subcent": SUBCENT,
    "daily_nested": SHIPMENTS_DAILY,
    "daily_dedup_order": f"{_sales(ORDER_TOTALS, SHIPMENT_ID)} SELECT * FROM daily",
    "orders_clean": f"""{STAR}
SELECT order_id, customer_id, city, channel, order_date, items_sold, round(gross_revenue_eur, 2) gross_revenue_eur
FROM orders_clean""",
    "rejects": f"""
SELECT {HEAD}, item_qty, item_sku, item_unit_price, item_qty_d, item_unit_price_d
FROM (SELECT *, {TEXT_CLEAN} FROM ({EXPLODED}) WHERE payment_status = 'paid') WHERE item_unit_price_d < 0""",
    "kept_lines": f"SELECT {LINE_COLUMNS}, item_qty_d, item_unit_price_d FROM ({_kept(LINES, NATIVE_CLEAN)})",
    "paid_orders": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    "explode_items": EXPLODED,
    "explode_keep_empty": f"{EXPLODED} UNION ALL {EMPTY}",
    "dedup_first": """
SELECT * EXCLUDE (l_tax, l_linestatus) FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey,
                           l_quantity, l_extendedprice, l_discount, l_returnflag) = 1""",
    "per_order": f"""
SELECT order_id, customer_id, channel, created_at, CAST(sum(item_qty_d) AS BIGINT) items_sold,
       round(sum(item_qty_d * item_unit_price_d), 2) gross_revenue_eur
FROM ({_kept(LINES, NATIVE_CLEAN)}) GROUP BY order_id, customer_id, channel, created_at""",
    "refunds_clean": _refunds(ORDER_ID),
    "refunds_sum": REFUNDS_SUM,
    "active_orders": f"""
SELECT customer_id, o_orderkey, city
FROM orders JOIN ({CUSTOMERS}) ON CAST(o_custkey AS VARCHAR) = customer_id WHERE is_active""",
    "refund_join": f"""
SELECT CAST(o_orderkey AS VARCHAR) order_id, o_totalprice, coalesce(refunds_eur, 0.0) refunds_eur
FROM orders LEFT JOIN ({REFUNDS_SUM}) ON order_id = CAST(o_orderkey AS VARCHAR)""",
    "safe_double": f"SELECT event_id, {_number('value')} AS value FROM ({DIRTY})",
    "bad_counts": f"""
SELECT event_type, CAST(sum({_bad('value')}) AS BIGINT) value_non_numeric FROM ({DIRTY}) GROUP BY event_type""",
    "bool_norm": f"SELECT customer_id, is_active FROM ({CUSTOMERS})",
    "order_date": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') order_date FROM orders",
    "date_key": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') date_key FROM orders",
    "left_join": """
SELECT o_orderkey, o_custkey, n_lines
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) n_lines FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "join_inner": _debtors("INNER"),
    "join_right": _debtors("RIGHT"),
    "join_full": _debtors("FULL"),
    "project": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "with_revenue": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
       round(l_quantity * l_extendedprice, 2) revenue FROM lineitem""",
    "city_revenue": """
SELECT n_name city, round(sum(o_totalprice), 2) total_revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "local_sales": """
SELECT payment_status, round(sum(o_totalprice), 2) total_revenue
FROM orders JOIN (VALUES ('F', 'paid'), ('P', 'pending'), ('O', 'failed')) t(status, payment_status)
  ON o_orderstatus = status GROUP BY payment_status""",
    "filter_gt": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 23",
    "filter_even": "SELECT l_partkey FROM lineitem WHERE l_partkey % 2 = 0",
    "map_double": """
SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) cents FROM orders WHERE round(o_totalprice * 100) > 9999""",
    "upper_lines": "SELECT upper(c_mktsegment) AS value FROM customer",
    "flat_map_words": "SELECT p_partkey, unnest(string_split(p_name, ' ')) word FROM part",
    "reduce_by_key": "SELECT event_type, round(sum(value), 2) total FROM events GROUP BY event_type",
    "group_by_key": _groups("events", "event_type", "event_id"),
    "group_by_expr": _groups("orders", "o_orderkey % 2", "o_orderkey"),
    "global_reduce": "SELECT sum(l_quantity) total, count(*) AS rows FROM lineitem",
    "distinct": "SELECT DISTINCT user_id, event_type FROM events",
    "distinct_counts": """
SELECT o_orderstatus, count(DISTINCT o_orderkey) orders, count(DISTINCT o_custkey) customers
FROM orders GROUP BY o_orderstatus""",
    "distinct_estimate": """
SELECT o_orderstatus, count(DISTINCT o_custkey) customers, true orders_near, true customers_near
FROM orders GROUP BY o_orderstatus""",
    "distinct_sketches": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name city, count(DISTINCT o_custkey) customers,
       true orders_near, true customers_near
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    "merge_by_key": """
SELECT event_type, event_id, user_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) = 1""",
    "merge_global": "SELECT bit_xor(l_orderkey * 8 + l_linenumber) AS xor FROM lineitem",
    "merge_in_order": """
SELECT o_custkey, string_agg(o_orderstatus, '' ORDER BY o_orderdate, o_orderkey) states
FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) before FROM orders)
WHERE before IS NULL OR before <> o_orderstatus GROUP BY o_custkey""",
    "sort_values": """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders""",
    "sort_ascending": """
SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS position FROM customer""",
    "top_words": f"{WORDS} ORDER BY count DESC, word LIMIT 20",
    "union_all": "SELECT c_custkey AS key FROM customer UNION ALL SELECT s_suppkey FROM supplier",
    "intersect": "SELECT o_custkey AS key FROM orders INTERSECT SELECT l_suppkey FROM lineitem",
    "word_count_df": WORDS,
    "word_count_rdd": _raw_words("documents"),
    "word_pairs": _raw_words("conversations"),
    "reconcile": f"""
WITH a AS ({REFUNDS_SUM}), b AS ({ALTERED})
SELECT order_id, refunds_eur, 'left' side, count(*) copies FROM (FROM a EXCEPT ALL FROM b) GROUP BY ALL
UNION ALL
SELECT order_id, refunds_eur, 'right' side, count(*) copies FROM (FROM b EXCEPT ALL FROM a) GROUP BY ALL""",
    "reconcile_keys": """
WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderkey % 50 kind FROM orders)
SELECT o_orderkey, CAST(0 AS BIGINT) nth, 'o_totalprice' AS column, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS left,
       CAST(CAST(o_totalprice + 1 AS DECIMAL(18, 2)) AS VARCHAR) AS right, 1.0::DOUBLE delta FROM o WHERE kind IN (0, 5)
UNION ALL SELECT o_orderkey, 0, 'o_orderstatus', o_orderstatus, 'X', NULL FROM o WHERE kind = 2
UNION ALL SELECT o_orderkey, 0, '*', '1', '0', -1.0 FROM o WHERE kind IN (3, 4)
UNION ALL SELECT -o_orderkey, 0, '*', '0', '1', 1.0 FROM o WHERE kind = 4""",
    "src_csv": CUSTOMERS,
    "src_csv_infer": "SELECT * FROM customer",
    "src_csv_refunds": _refunds(ORDER_ID),
    "src_json_nested": EXPLODED,
    "src_json_arrays": EXPLODED,
    "src_json_numbers": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) order_id,
       CASE l_linenumber WHEN 1 THEN 100 * CAST(l_quantity AS INTEGER) WHEN 2 THEN 1000000 * CAST(l_quantity AS INTEGER)
                         WHEN 3 THEN 0 ELSE l_quantity END + 0.0 item_qty_d,
       l_extendedprice item_unit_price_d, l_linenumber = 3 OR l_quantity = 0 bad
FROM lineitem""",
    "src_json_bad_counts": """
SELECT count(*) orders_rows_paid, count(*) FILTER (l_linenumber <> 1) items_qty_non_numeric,
       CAST(0 AS BIGINT) items_unit_price_non_numeric
FROM lineitem""",
    "src_json_malformed": """
WITH lines AS (
  SELECT o_orderkey, '{"order_id":"' || CAST(o_orderkey AS VARCHAR) || '","payment_status":"paid"}' line FROM orders)
SELECT CASE WHEN o_orderkey % 7 = 0 THEN left(line, length(line) - 5) ELSE replace(line, '}', ',"items":"none"}') END record,
       true has_file, (SELECT count(*) FROM orders WHERE o_orderkey % 7 <> 0) paid
FROM lines WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""",
    "src_csv_drift": """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) o_custkey, o_totalprice, NULL o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL, floor(o_totalprice), NULL FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, 'C' || CAST(o_custkey AS VARCHAR), o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
    "src_text": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "sink_csv": STAR_DAILY,
    "sink_csv_order": f"""{STAR}
SELECT date, city, channel, row_number() OVER (ORDER BY date, city, channel) AS position FROM daily""",
    "sink_partitioned": f"{STAR} SELECT *, replace(date, '-', '') date_key FROM daily",
    "sink_partitioned_filter": f"""{STAR}
SELECT *, replace(date, '-', '') date_key FROM daily WHERE date BETWEEN '1997-01-01' AND '1997-12-31'""",
    "sink_partitioned_rerun": """
SELECT date, replace(date, '-', '') date_key, o_orderstatus, CASE WHEN date LIKE '1995-%' THEN -total ELSE total END total
FROM (SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS date, o_orderstatus, round(sum(o_totalprice), 2) total
      FROM orders GROUP BY ALL)""",
    "dates_from_table": """
SELECT l_orderkey, l_linenumber, l_quantity, strftime(l_shipdate, 'm%Y%m') AS month FROM lineitem
WHERE strftime(l_shipdate, 'm%Y%m') IN (
  SELECT strftime(o_orderdate, 'm%Y%m') FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 490000)""",
    "sink_table_swap": f"{STAR} SELECT * FROM daily WHERE channel = 'web'",
    "join_bucketed": """
SELECT o_orderkey, o_totalprice, quantity
FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) quantity FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "sink_table": STAR_DAILY,
    "sink_table_fallback": STAR_DAILY,
    "run_metrics": COUNTERS,
    "job_daily": SHIPMENTS_DAILY,
    "job_fallback": SHIPMENTS_DAILY,
    "job_rejects": f"""
SELECT {HEAD}, item_qty, item_sku, item_unit_price, item_qty_d, item_unit_price_d
FROM (SELECT *, {TEXT_CLEAN} FROM ({EXPLODED}) WHERE payment_status = 'paid') WHERE item_unit_price_d < 0""",
    "run_report": COUNTERS.replace("SELECT (SELECT count(*) FROM cust)", "SELECT 'OK' status, (SELECT count(*) FROM cust)"),
}
