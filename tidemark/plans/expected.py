"""The expected result of each query, as SQL over the plain test tables.

Nothing here goes through messages, streams or written tables: the SQL states from the table rows
what the change operators must find.
"""

from __future__ import annotations

# Must equal the base time in sources.feeds.
T0 = 1704067200000

ITEM_KEY = "(l_orderkey * 8 + l_linenumber)"
ITEM = f"""{ITEM_KEY} AS id, l_orderkey AS order_id, l_partkey AS product_id,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
  epoch_ms(l_shipdate) AS created_at"""

CUSTOMERS = f"""
c AS (
  SELECT c_custkey AS k, CAST(c_custkey AS BIGINT) AS id, c_mktsegment AS first_name,
    c_name AS last_name,
    CASE WHEN c_custkey % 10 = 0 THEN 'd' WHEN c_custkey % 10 <= 3 THEN 'u'
         WHEN c_custkey % 10 = 4 THEN 'r' ELSE 'c' END AS op,
    lower(replace(c_name, '#', '.')) || '@example.com' AS old_email,
    CASE WHEN c_custkey % 20 IN (1, 2, 3) THEN 'new.' ELSE '' END
      || lower(replace(c_name, '#', '.')) || '@example.com' AS new_email,
    {T0} + c_custkey * 1000 + 999 AS ts_ms,
    make_timestamp(({T0} + c_custkey * 1000 + 999) * 1000) AS ts,
    {T0} + c_custkey AS created_at,
    CASE WHEN c_custkey % 2 = 1 THEN 'shop.sales.customers.Envelope' END AS schema_name,
    CASE WHEN c_custkey % 2 = 1 THEN CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END END
      AS schema_version,
    CASE WHEN c_custkey % 3 = 0 THEN '555-' || c_custkey END AS phone
  FROM customer)
"""

PRODUCTS = f"""
p AS (
  SELECT p_partkey AS k, CAST(p_partkey AS BIGINT) AS id, p_name AS name, p_type AS category,
    CASE WHEN p_partkey % 5 = 0 THEN 'c' WHEN p_partkey % 5 = 4 THEN 'd' ELSE 'u' END AS op,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS old_price,
    CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END
      AS DECIMAL(10,2)) AS new_price,
    p_size AS old_stock,
    CAST(p_size + p_partkey % 3 - 1 AS INTEGER) AS new_stock,
    {T0} + p_partkey * 500 AS ts_ms,
    make_timestamp(({T0} + p_partkey * 500) * 1000) AS ts
  FROM part)
"""

ORDERS = """
o AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS BIGINT) AS id,
    CASE WHEN o_orderkey % 3 = 0 THEN 'c' WHEN o_orderkey % 3 = 1 THEN 'u' ELSE 'd' END AS op,
    CAST(o_custkey AS BIGINT) AS customer_id,
    CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount, o_orderstatus AS status,
    epoch_ms(o_orderdate) AS ts_ms, o_orderdate AS ts
  FROM orders)
"""

ALL_CHANGES = f"""
{CUSTOMERS}, {PRODUCTS}, {ORDERS},
a AS (
  SELECT 'customers' AS table_name, k, op, ts, ts_ms FROM c
  UNION ALL SELECT 'products', k, op, ts, ts_ms FROM p
  UNION ALL SELECT 'orders', k, op, ts, ts_ms FROM o)
"""

RAW_SALES = """
raw AS (
  SELECT CAST(o_custkey AS BIGINT) AS customer_id, CAST(l_partkey AS BIGINT) AS product_id,
    CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
    o_orderdate AS created_at, CAST(o_orderdate AS DATE) AS sale_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

DAILY = f"""
{RAW_SALES},
daily AS (
  SELECT sale_date, count(*) AS total_transactions,
    CAST(sum(quantity * price) AS DECIMAL(20,2)) AS total_revenue,
    CAST(sum(quantity * price) AS DOUBLE) / count(quantity * price) AS avg_transaction_value,
    count(DISTINCT customer_id) AS unique_customers
  FROM raw GROUP BY sale_date)
"""

REPORT = f"""
WITH {DAILY}
SELECT sale_date, total_transactions AS transactions, total_revenue AS revenue,
  avg_transaction_value AS average_value, unique_customers
FROM daily ORDER BY sale_date
"""

COHORTS = """
base AS (
  SELECT user_id, CAST(min(ts) OVER (PARTITION BY user_id) AS DATE) AS signup_date,
    CAST(ts AS DATE) AS activity_date
  FROM events),
sizes AS (
  SELECT signup_date, count(DISTINCT user_id) AS cohort_size FROM base GROUP BY signup_date),
retained AS (
  SELECT signup_date, CAST(date_diff('day', signup_date, activity_date) AS INTEGER) AS day_diff,
    count(DISTINCT user_id) AS retained_users
  FROM base WHERE activity_date >= signup_date GROUP BY 1, 2)
"""

RETENTION = f"""
WITH {COHORTS}
SELECT signup_date, day_diff, retained_users, cohort_size,
  CAST(retained_users AS DOUBLE) / cohort_size AS retention_rate
FROM retained JOIN sizes USING (signup_date) ORDER BY signup_date, day_diff
"""

VOLUME = """
SELECT CAST(c_custkey >= mid AS BIGINT) AS batch_id, count(*) AS change_count
FROM customer,
  (SELECT CAST(floor(min(c_custkey) + (max(c_custkey) - min(c_custkey)) / 2.0) AS BIGINT) AS mid
   FROM customer)
GROUP BY 1
"""

HISTORY = """
h AS (
  SELECT CAST(o_custkey AS BIGINT) AS id, o_orderstatus AS first_name,
    o_orderpriority AS last_name, 'order.' || o_orderkey || '@example.com' AS email,
    epoch_ms(o_orderdate) AS created_at, epoch_ms(o_orderdate) AS updated_at,
    o_orderkey % 10 = 0 AS deleted,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
"""

STATE = f"""
WITH {HISTORY}
SELECT id, first_name, last_name, email, created_at, updated_at
FROM h WHERE rn = 1 AND NOT deleted
"""

MINUTES = (
    "date_trunc('minute', ts) AS window_start, "
    "date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end"
)

METRICS = f"""
WITH {ALL_CHANGES}
SELECT {MINUTES}, table_name, op AS operation, count(*) AS change_count
FROM a GROUP BY ALL
"""

FLAT_CUSTOMER = """
op AS operation, 'customers' AS table_name, ts_ms AS source_timestamp,
CASE WHEN op IN ('u', 'd') THEN id END AS before_id,
CASE WHEN op IN ('u', 'd') THEN old_email END AS before_email,
CASE WHEN op <> 'd' THEN id END AS after_id,
CASE WHEN op <> 'd' THEN new_email END AS after_email
"""

STOCK = """
SELECT id AS product_id, name AS product_name, old_stock, new_stock,
  new_stock - old_stock AS change
FROM p WHERE op = 'u' AND old_stock <> new_stock
"""

ENRICHED = f"""
WITH {ORDERS}
SELECT customer_id, id AS order_id, total_amount, status, op AS operation,
  ts_ms AS source_timestamp, c_mktsegment AS first_name, c_name AS last_name,
  lower(c_name) AS email
FROM o LEFT JOIN customer ON customer_id = c_custkey
"""

ANOMALIES = f"""
WITH {ORDERS},
usual AS (
  SELECT customer_id, count(total_amount) AS order_count,
    avg(CAST(total_amount AS DOUBLE)) AS mean_amount,
    stddev_samp(CAST(total_amount AS DOUBLE)) AS deviation
  FROM o GROUP BY customer_id HAVING count(total_amount) >= 5)
SELECT o.id AS order_id, o.customer_id, o.total_amount, order_count
FROM o JOIN usual USING (customer_id)
WHERE CAST(o.total_amount AS DOUBLE) > mean_amount + 2 * deviation
"""

TYPED_PATHS = f"""
WITH {CUSTOMERS}
SELECT ts AS "timestamp", op AS operation,
  CASE WHEN op <> 'd' THEN id END AS customer_id,
  CASE WHEN op <> 'd' THEN c.first_name END AS first_name,
  CASE WHEN op <> 'd' THEN c.last_name END AS last_name,
  CASE WHEN op <> 'd' THEN new_email END AS email,
  ts_ms AS source_timestamp
FROM c
"""

LOG = f"""
WITH {ALL_CHANGES}
SELECT table_name, CAST(ts AS DATE) AS event_date, op AS operation, count(*) AS change_count,
  CAST(sum(k) AS BIGINT) AS id_sum, max(k) AS last_offset
FROM a GROUP BY ALL
"""

SQL: dict[str, str] = {
    # ---- sources and sinks
    "change_stream": f"""
WITH {CUSTOMERS}
SELECT 'shop.sales.customers' AS topic, CAST(k % 4 AS INTEGER) AS partition, k AS "offset",
  ts AS "timestamp", '{{"id":' || k || '}}' AS message_key
FROM c
""",
    "multi_topic_stream": """
SELECT 'shop.sales.customers' AS topic, count(*) AS message_count FROM customer
UNION ALL SELECT 'shop.sales.orders', count(*) FROM orders
""",
    "change_history": f"""
WITH {ALL_CHANGES}
SELECT 'shop.sales.' || table_name AS topic, CAST(k % 4 AS INTEGER) AS partition,
  count(*) AS message_count, min(k) AS first_offset, max(k) AS last_offset
FROM a GROUP BY 1, 2
""",
    "table_scan": """
SELECT o_orderstatus, count(*) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total
FROM orders GROUP BY o_orderstatus
""",
    "run_stream": f"""
WITH {PRODUCTS}
SELECT 'op_counts' AS result, op || '|' || count(*) AS "row" FROM p GROUP BY op
UNION ALL SELECT 'restock', concat_ws('|', id, name, old_stock, new_stock, new_stock - old_stock)
  FROM p WHERE op = 'u' AND old_stock >= 10 AND new_stock < 10
""",
    "append_staging": f"WITH {RAW_SALES} SELECT * FROM raw",
    "write_metrics": f"WITH {DAILY} SELECT * FROM daily",
    "archive_metrics": f"WITH {DAILY} SELECT * FROM daily",
    # ---- parsing
    "parse_changes_customers": f"""
WITH {CUSTOMERS}
SELECT '{{"id":' || k || '}}' AS message_key, ts AS "timestamp", op, ts_ms + 5 AS ts_ms,
  CAST(NULL AS VARCHAR) AS "transaction", ts_ms AS source_ts_ms, 'customers' AS source_table,
  'postgresql' AS connector, k * 8 AS lsn,
  CASE WHEN op IN ('u', 'd') THEN id END AS before_id,
  CASE WHEN op IN ('u', 'd') THEN old_email END AS before_email,
  CASE WHEN op <> 'd' THEN id END AS after_id,
  CASE WHEN op <> 'd' THEN first_name END AS after_first_name,
  CASE WHEN op <> 'd' THEN last_name END AS after_last_name,
  CASE WHEN op <> 'd' THEN new_email END AS after_email,
  CASE WHEN op <> 'd' THEN created_at END AS after_created_at
FROM (SELECT k, id, op, old_email, new_email, first_name, last_name, created_at, ts, ts_ms FROM c)
""",
    "parse_changes_products": f"""
WITH {PRODUCTS}
SELECT op, ts_ms AS source_ts_ms,
  CASE WHEN op IN ('u', 'd') THEN old_price END AS before_price,
  CASE WHEN op IN ('u', 'd') THEN old_stock END AS before_stock,
  CASE WHEN op <> 'd' THEN id END AS after_id,
  CASE WHEN op <> 'd' THEN name END AS after_name,
  CASE WHEN op <> 'd' THEN category END AS after_category,
  CASE WHEN op <> 'd' THEN new_price END AS after_price,
  CASE WHEN op <> 'd' THEN new_stock END AS after_stock
FROM p
""",
    "parse_wrapped_changes": f"""
WITH {CUSTOMERS}
SELECT ts AS kafka_timestamp, schema_name, schema_version, {FLAT_CUSTOMER} FROM c
""",
    "parse_change_paths": f"""
WITH {CUSTOMERS}
SELECT ts AS "timestamp", op AS operation,
  CASE WHEN op <> 'd' THEN CAST(id AS VARCHAR) END AS customer_id,
  CASE WHEN op <> 'd' THEN new_email END AS email
FROM c
""",
    "parse_change_paths_typed": TYPED_PATHS,
    "variant_change_paths": TYPED_PATHS,
    "schema_drift": f"""
WITH {CUSTOMERS}, {PRODUCTS},
counts AS (
  SELECT (SELECT count(*) FROM c WHERE op <> 'd') AS customers, (SELECT count(*) FROM p WHERE op <> 'd') AS products,
    (SELECT count(*) FROM c WHERE op <> 'd' AND phone IS NOT NULL) AS phones),
prices AS (
  SELECT max(length(CAST(CAST(floor(new_price) AS BIGINT) AS VARCHAR))) AS digits,
    max(CASE WHEN new_price * 10 % 1 <> 0 THEN 2 WHEN new_price % 1 <> 0 THEN 1 ELSE 0 END) AS scale
  FROM p WHERE op <> 'd'),
fields(table_name, field, seen_type, declared_type, status) AS (VALUES
  ('customers', 'id', 'BIGINT', 'bigint', 'declared'), ('customers', 'first_name', 'STRING', 'string', 'declared'),
  ('customers', 'last_name', 'STRING', 'string', 'declared'), ('customers', 'email', 'STRING', 'string', 'declared'),
  ('customers', 'created_at', 'BIGINT', 'bigint', 'declared'), ('customers', 'updated_at', 'BIGINT', 'bigint', 'declared'),
  ('customers', 'phone', 'STRING', NULL, 'undeclared'), ('products', 'id', 'BIGINT', 'bigint', 'declared'),
  ('products', 'name', 'STRING', 'string', 'declared'), ('products', 'description', 'VOID', 'string', 'declared'),
  ('products', 'price', 'DECIMAL', 'decimal(10,2)', 'declared'), ('products', 'quantity_in_stock', 'BIGINT', 'int', 'declared'),
  ('products', 'category', 'STRING', 'string', 'declared'), ('products', 'created_at', 'BIGINT', 'bigint', 'declared'),
  ('products', 'updated_at', 'BIGINT', 'bigint', 'declared'))
SELECT table_name, field, CASE WHEN seen_type = 'DECIMAL' THEN 'DECIMAL(' || (digits + scale) || ',' || scale || ')' ELSE seen_type END AS seen_type,
  declared_type, CASE WHEN field = 'phone' THEN phones WHEN table_name = 'customers' THEN customers ELSE products END AS changes, status
FROM fields, counts, prices
""",
    "changes": f"WITH {CUSTOMERS} SELECT ts AS kafka_timestamp, {FLAT_CUSTOMER} FROM c",
    "message_metadata": f"""
SELECT 'shop-avro.sales.customers' AS topic, CAST(c_custkey % 4 AS INTEGER) AS partition,
  c_custkey AS "offset", make_timestamp(({T0} + c_custkey * 1000) * 1000) AS "timestamp",
  CAST(c_custkey AS VARCHAR) AS message_key, '0000000001' || hex(c_name) AS avro_value
FROM customer
""",
    "first_messages": f"""
SELECT 'shop-avro.sales.customers' AS topic, CAST(c_custkey % 4 AS INTEGER) AS partition,
  c_custkey AS "offset", make_timestamp(({T0} + c_custkey * 1000) * 1000) AS "timestamp",
  CAST(c_custkey AS VARCHAR) AS message_key, '0000000001' || hex(c_name) AS avro_value
FROM customer ORDER BY c_custkey % 4, c_custkey LIMIT 5
""",
    "topic_ops": f"""
WITH {ALL_CHANGES}
SELECT 'shop.sales.' || table_name AS topic, ts AS "timestamp", op AS operation, table_name
FROM a
""",
    "evolved_customers": f"""
WITH {CUSTOMERS}
SELECT op AS operation, id, CASE WHEN op = 'd' THEN old_email ELSE new_email END AS email, phone
FROM c
""",
    # ---- change analysis
    "op_counts": f"""
WITH {CUSTOMERS} SELECT op AS operation, count(*) AS change_count FROM c GROUP BY op
""",
    "inserted_rows": f"""
WITH {CUSTOMERS}
SELECT id, first_name, last_name, new_email AS email, created_at, ts_ms AS updated_at
FROM c WHERE op IN ('c', 'r')
""",
    "inserted_order_items": f"SELECT {ITEM} FROM lineitem WHERE {ITEM_KEY} % 4 IN (0, 3)",
    "deleted_order_items": f"SELECT {ITEM} FROM lineitem WHERE {ITEM_KEY} % 4 = 2",
    "updated_emails": f"""
WITH {CUSTOMERS}
SELECT id AS customer_id, old_email, new_email, ts_ms AS source_timestamp FROM c WHERE op = 'u'
""",
    "updated_emails_timed": f"""
WITH {CUSTOMERS}
SELECT id AS customer_id, old_email, new_email, strftime(ts, '%Y-%m-%d %H:%M:%S') AS change_time
FROM c WHERE op = 'u'
""",
    "email_changes": f"""
WITH {CUSTOMERS}
SELECT id AS customer_id, first_name, last_name, old_email, new_email
FROM c WHERE op = 'u' AND old_email <> new_email
""",
    "deleted_rows": f"""
WITH {CUSTOMERS}
SELECT id, first_name, last_name, old_email AS email, created_at, ts_ms AS updated_at
FROM c WHERE op = 'd'
""",
    "price_changes": f"""
WITH {PRODUCTS}
SELECT id AS product_id, name AS product_name, old_price, new_price
FROM p WHERE op = 'u' AND old_price <> new_price
""",
    "stock_changes": f"WITH {PRODUCTS} {STOCK}",
    "schema_versions": f"WITH {CUSTOMERS} SELECT DISTINCT schema_name, schema_version FROM c",
    "history_op_counts": f"""
WITH {ORDERS} SELECT op AS operation, count(*) AS change_count FROM o GROUP BY ROLLUP (op)
""",
    "batch_volume": VOLUME,
    # ---- streaming
    "change_metrics": METRICS,
    "change_metrics_history": METRICS,
    "op_stats": f"""
SELECT {MINUTES}, event_type AS operation, count(*) AS change_count FROM events GROUP BY ALL
""",
    "op_stats_complete": f"""
SELECT {MINUTES}, event_type AS operation, count(*) AS change_count FROM events GROUP BY ALL
""",
    "open_windows": f"""
SELECT * FROM ({METRICS}) WHERE window_end > (WITH {ALL_CHANGES} SELECT max(ts) FROM a) - INTERVAL 1 MINUTE
""",
    "late_changes": f"""
WITH {ORDERS},
mark AS (SELECT max(ts) - INTERVAL 1 MINUTE AS watermark FROM o WHERE k % 4 <> 0)
SELECT {MINUTES}, 'orders' AS table_name, op AS operation, count(*) AS change_count
FROM o, mark
WHERE k % 4 <> 0 OR date_trunc('minute', ts) + INTERVAL 1 MINUTE > watermark
GROUP BY ALL
""",
    "run_all": f"""
WITH {ALL_CHANGES}
SELECT 'inserted' AS result,
  concat_ws('|', id, first_name, last_name, new_email, created_at, ts_ms) AS "row"
FROM c WHERE op IN ('c', 'r')
UNION ALL SELECT 'email_changes', concat_ws('|', id, first_name, last_name, old_email, new_email)
  FROM c WHERE op = 'u' AND old_email <> new_email
UNION ALL SELECT 'price_changes', concat_ws('|', id, name, old_price, new_price)
  FROM p WHERE op = 'u' AND old_price <> new_price
UNION ALL SELECT 'stock_changes', concat_ws('|', id, name, old_stock, new_stock, new_stock - old_stock)
  FROM p WHERE op = 'u' AND old_stock <> new_stock
UNION ALL SELECT 'metrics', concat_ws('|', minute, table_name, op, count(*))
  FROM (SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, table_name, op FROM a)
  GROUP BY minute, table_name, op
""",
    # ---- sales, retention, quality
    "staging_sales": f"WITH {RAW_SALES} SELECT * FROM raw",
    "extract_daily_sales": f"""
WITH {RAW_SALES}
SELECT * FROM raw WHERE sale_date = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
""",
    "daily_metrics": f"WITH {DAILY} SELECT * FROM daily",
    "retain_recent": f"""
WITH {RAW_SALES}
SELECT * FROM raw
WHERE created_at >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 7 DAY
  OR created_at IS NULL
""",
    "validate_extract": f"""
WITH {RAW_SALES}
SELECT 'missing customer_id' AS check_name, count(*) FILTER (customer_id IS NULL) AS violations
FROM raw
UNION ALL SELECT 'missing product_id', count(*) FILTER (product_id IS NULL) FROM raw
UNION ALL SELECT 'missing quantity', count(*) FILTER (quantity IS NULL) FROM raw
UNION ALL SELECT 'missing price', count(*) FILTER (price IS NULL) FROM raw
UNION ALL SELECT 'missing sale_date', count(*) FILTER (sale_date IS NULL) FROM raw
UNION ALL SELECT 'wrong day', count(*) FILTER (sale_date <> CAST(created_at AS DATE)) FROM raw
UNION ALL SELECT 'lost rows', 0
UNION ALL SELECT 'gained rows', 0
UNION ALL SELECT 'undated rows', count(*) - count(created_at) FROM raw
""",
    "daily_report": REPORT,
    "daily_sales_run": f"""
SELECT * FROM ({REPORT})
WHERE sale_date < (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
""",
    "cohort_retention": RETENTION,
    "kept_cohort_retention": RETENTION,
    "kept_active_users": """
SELECT CAST(ts AS DATE) AS activity_date, count(DISTINCT user_id) AS unique_users FROM events GROUP BY 1
""",
    "cohort_sizes": f"WITH {COHORTS} SELECT * FROM sizes",
    "daily_retention": f"WITH {COHORTS} SELECT * FROM retained",
    "source_totals": """
SELECT sum(n)::BIGINT AS total_records,
  string_agg(source, ',' ORDER BY source) FILTER (n > 0) AS sources
FROM (SELECT 'customer' AS source, count(*) AS n FROM customer
      UNION ALL SELECT 'orders', count(*) FROM orders
      UNION ALL SELECT 'lineitem', count(*) FROM lineitem
      UNION ALL SELECT 'events', count(*) FROM events)
""",
    "row_count_gate": """
SELECT total_records, total_records >= 100 AS passed
FROM (SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)
        + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS total_records)
""",
    "reconcile_order_totals": """
WITH lines AS (
  SELECT l_orderkey,
    sum(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(10,2))) AS line_total
  FROM lineitem GROUP BY l_orderkey),
compared AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id,
    CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
    CAST(coalesce(line_total, 0) AS DECIMAL(20,2)) AS line_total
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey)
SELECT *, CAST(total_amount - line_total AS DECIMAL(20,2)) AS difference
FROM compared WHERE total_amount IS DISTINCT FROM line_total
""",
    "constraint_report": """
WITH checks AS (
  SELECT 'customers' AS table_name, 'not null' AS rule, 'id' AS column_name,
    count(*) FILTER (c_custkey IS NULL) AS violations FROM customer
  UNION ALL SELECT 'customers', 'not null', 'first_name',
    count(*) FILTER (c_mktsegment IS NULL) FROM customer
  UNION ALL SELECT 'customers', 'not null', 'last_name',
    count(*) FILTER (c_name IS NULL) FROM customer
  UNION ALL SELECT 'customers', 'not null', 'email', count(*) FILTER (c_name IS NULL) FROM customer
  UNION ALL SELECT 'customers', 'unique', 'id', count(c_custkey) - count(DISTINCT c_custkey)
    FROM customer
  UNION ALL SELECT 'customers', 'unique', 'email', count(c_name) - count(DISTINCT lower(c_name))
    FROM customer
  UNION ALL SELECT 'products', 'not null', 'id', count(*) FILTER (p_partkey IS NULL) FROM part
  UNION ALL SELECT 'products', 'not null', 'name', count(*) FILTER (p_name IS NULL) FROM part
  UNION ALL SELECT 'products', 'not null', 'price', count(*) FILTER (p_retailprice IS NULL)
    FROM part
  UNION ALL SELECT 'products', 'unique', 'id', count(p_partkey) - count(DISTINCT p_partkey)
    FROM part
  UNION ALL SELECT 'orders', 'not null', 'id', count(*) FILTER (o_orderkey IS NULL) FROM orders
  UNION ALL SELECT 'orders', 'not null', 'total_amount',
    count(*) FILTER (o_totalprice IS NULL) FROM orders
  UNION ALL SELECT 'orders', 'unique', 'id', count(o_orderkey) - count(DISTINCT o_orderkey)
    FROM orders
  UNION ALL SELECT 'orders', 'foreign key', 'customer_id', count(*) FROM orders
    WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'order_items', 'not null', 'id',
    count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) FROM lineitem
  UNION ALL SELECT 'order_items', 'not null', 'quantity',
    count(*) FILTER (l_quantity IS NULL) FROM lineitem
  UNION ALL SELECT 'order_items', 'not null', 'unit_price',
    count(*) FILTER (l_extendedprice IS NULL) FROM lineitem
  UNION ALL SELECT 'order_items', 'unique', 'id',
    count(l_orderkey * 8 + l_linenumber) - count(DISTINCT l_orderkey * 8 + l_linenumber)
    FROM lineitem
  UNION ALL SELECT 'order_items', 'foreign key', 'order_id', count(*) FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'order_items', 'foreign key', 'product_id', count(*) FROM lineitem
    WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)
  UNION ALL SELECT 'addresses', 'not null', 'id', count(*) FILTER (s_suppkey IS NULL) FROM supplier
  UNION ALL SELECT 'addresses', 'not null', 'street_address', count(*) FILTER (s_name IS NULL)
    FROM supplier
  UNION ALL SELECT 'addresses', 'not null', 'city', count(*) FILTER (s_nationkey IS NULL) FROM supplier
  UNION ALL SELECT 'addresses', 'not null', 'country', count(*) FILTER (s_nationkey IS NULL)
    FROM supplier
  UNION ALL SELECT 'addresses', 'unique', 'id', count(s_suppkey) - count(DISTINCT s_suppkey)
    FROM supplier
  UNION ALL SELECT 'addresses', 'foreign key', 'customer_id', count(*) FROM supplier
    WHERE s_suppkey IS NOT NULL AND s_suppkey NOT IN (SELECT c_custkey FROM customer))
SELECT * FROM checks
""",
    "kept_constraint_report": """
WITH c AS (
  SELECT c_custkey AS id, c_mktsegment AS first_name, c_name AS last_name,
    CASE WHEN c_custkey % 10 = 1 THEN 'all@example.com' ELSE lower(c_name) END AS email
  FROM customer WHERE c_custkey % 10 <> 0),
o AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN -1 WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_custkey END AS customer_id,
    CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 = 5 THEN NULL ELSE o_totalprice END AS total_amount
  FROM orders)
SELECT 'customers' AS table_name, 'not null' AS rule, unnest(['id', 'first_name', 'last_name', 'email']) AS column_name,
  unnest([count(*) - count(id), count(*) - count(first_name), count(*) - count(last_name), count(*) - count(email)]) AS violations FROM c
UNION ALL SELECT 'orders', 'not null', unnest(['id', 'total_amount']), unnest([count(*) - count(id), count(*) - count(total_amount)]) FROM o
UNION ALL SELECT 'customers', 'unique', unnest(['id', 'email']), unnest([count(id) - count(DISTINCT id), count(email) - count(DISTINCT email)]) FROM c
UNION ALL SELECT 'orders', 'unique', 'id', count(id) - count(DISTINCT id) FROM o
UNION ALL SELECT 'orders', 'foreign key', 'customer_id', count(*) FROM o WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT id FROM c)
""",
    # ---- change log, state, insight
    "change_log": LOG,
    "compacted_change_log": LOG,
    "recoverable_stream": f"""
WITH {CUSTOMERS},
cuts AS (
  SELECT CAST(floor(min(k) + (max(k) - min(k)) / 3.0) AS BIGINT) AS first_cut,
    CAST(floor(min(k) + (max(k) - min(k)) * 2 / 3.0) AS BIGINT) AS second_cut FROM c)
SELECT k AS "offset", op AS operation, ts_ms AS source_timestamp,
  CAST(k >= first_cut AS BIGINT) + CAST(k >= second_cut AS BIGINT) AS batch_id
FROM c, cuts
""",
    "current_state": STATE,
    "merged_state": STATE,
    "kept_state": STATE,
    "address_state": f"""
SELECT s_suppkey AS id, s_suppkey AS customer_id, 'new ' || s_name AS street_address,
  'city ' || s_nationkey AS city, CAST(NULL AS VARCHAR) AS state, 'P-' || s_suppkey AS postal_code,
  'country ' || s_nationkey AS country,
  CASE WHEN s_suppkey % 2 = 0 THEN 'billing' ELSE 'shipping' END AS address_type,
  {T0} AS created_at, {T0} + s_suppkey * 1000 + 1 AS updated_at
FROM supplier WHERE s_suppkey % 5 <> 0
""",
    "enrich_changes": ENRICHED,
    "enrich_changes_as_of": f"""
WITH {ORDERS},
history AS (
  SELECT o_custkey AS customer_id, epoch_ms(o_orderdate) AS since, max(o_orderkey) AS k,
    arg_max(o_orderstatus, o_orderkey) AS first_name, arg_max(o_orderpriority, o_orderkey) AS last_name
  FROM orders GROUP BY 1, 2),
versions AS (
  SELECT customer_id, since, CASE WHEN k % 10 <> 0 THEN first_name END AS first_name,
    CASE WHEN k % 10 <> 0 THEN last_name END AS last_name,
    CASE WHEN k % 10 <> 0 THEN 'order.' || k || '@example.com' END AS email
  FROM history)
SELECT o.customer_id, o.id AS order_id, total_amount, status, op AS operation, ts_ms AS source_timestamp,
  first_name, last_name, email
FROM o ASOF LEFT JOIN versions v ON o.customer_id = v.customer_id AND o.ts_ms >= v.since
""",
    "enrich_change_stream": ENRICHED,
    "order_lines_stream": f"""
WITH {ORDERS},
placed AS (SELECT id AS order_id, customer_id, total_amount, make_timestamp(ts_ms * 1000) AS order_time FROM o WHERE op = 'c'),
items AS (SELECT *, make_timestamp(created_at * 1000) AS item_time FROM (SELECT {ITEM} FROM lineitem) WHERE id % 4 IN (0, 3)),
mark AS (
  SELECT least((SELECT max(order_time) FROM placed), (SELECT max(item_time) FROM items)) - INTERVAL 36 HOUR AS passed),
lines AS (
  SELECT p.*, i.id AS item_id, product_id, quantity, unit_price, item_time
  FROM placed p LEFT JOIN items i ON i.order_id = p.order_id
    AND item_time BETWEEN order_time AND order_time + INTERVAL 60 DAY)
SELECT lines.* FROM lines, mark WHERE item_id IS NOT NULL OR order_time + INTERVAL 60 DAY < passed
""",
    "observed_volume": VOLUME,
    "observed_late_changes": """
SELECT count(*) AS change_count,
  (SELECT max(CAST(o_orderdate AS TIMESTAMP)) FROM orders) - INTERVAL 1 MINUTE AS watermark
FROM orders
""",
    "transaction_anomalies": ANOMALIES,
    "kept_transaction_anomalies": ANOMALIES,
    "restock_alerts": f"""
WITH {PRODUCTS}, s AS ({STOCK}) SELECT * FROM s WHERE old_stock >= 10 AND new_stock < 10
""",
    "customer_activity_change": """
WITH counts AS (
  SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS period_start, count(*) AS event_count
  FROM events GROUP BY 1, 2)
SELECT coalesce(now.user_id, before.user_id) AS user_id,
  coalesce(now.period_start, before.period_start + 7) AS period_start,
  coalesce(now.event_count, 0) AS event_count,
  coalesce(before.event_count, 0) AS previous_count,
  coalesce(now.event_count, 0) - coalesce(before.event_count, 0) AS difference
FROM counts now FULL JOIN counts before
  ON now.user_id = before.user_id AND now.period_start = before.period_start + 7
WHERE coalesce(now.period_start, before.period_start + 7) <= (SELECT max(period_start) FROM counts)
""",
}
