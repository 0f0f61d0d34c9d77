"""DuckDB SQL for each registered query: the same results by a different formulation.

The feeds are re-derived from the raw tables here; windows use ``date_trunc``; averages use
integer cents; bursts use a pairwise self-join. Decimal results are compared as DOUBLE and
timestamps as TIMESTAMP (no zone), matching ``cartwheel.plans.queries.for_oracle``.
"""

EVENT_FEED = """
  SELECT CAST(event_id AS VARCHAR) AS order_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         'delivered' AS order_status,
         ts AS order_purchase_timestamp,
         CAST(event_id % 200 AS VARCHAR) AS product_id,
         CAST(event_id % 50 AS VARCHAR) AS seller_id,
         CASE WHEN event_type <> 'error' THEN event_type END AS product_category,
         CASE WHEN event_type <> 'signup' THEN CAST(value AS DECIMAL(12,2)) END AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(12,2)) AS freight_value
  FROM events"""

ITEM_FEED = """
  SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         o.o_orderstatus AS order_status,
         o.o_orderdate AS order_purchase_timestamp,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(l.l_suppkey AS VARCHAR) AS seller_id,
         p.product_category,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l.l_quantity AS DECIMAL(12,2)) AS freight_value
  FROM orders o
  LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN (SELECT p_partkey, max(nullif(p_type, '')) AS product_category FROM part GROUP BY p_partkey) p
         ON p.p_partkey = l.l_partkey"""

FEEDS = {"event": EVENT_FEED, "item": ITEM_FEED}

EVENT_COLUMNS = ("order_id, customer_id, order_status, order_purchase_timestamp, product_id, seller_id, "
                 "product_category, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value")


def with_feed(feed: str, body: str) -> str:
    return f"WITH feed AS ({FEEDS[feed]}\n)\n{body}"


def feed_rows(feed: str, where: str = "TRUE", extra: str = "") -> str:
    return with_feed(feed, f"SELECT {EVENT_COLUMNS}{extra} FROM feed WHERE {where}")


def revenue(feed: str, unit: str = "minute") -> str:
    return with_feed(feed, f"""
SELECT product_category,
       CAST(sum(coalesce(price, 0) + coalesce(freight_value, 0)) AS DOUBLE) AS total_revenue,
       count(*) AS order_count,
       date_trunc('{unit}', order_purchase_timestamp) AS window_start,
       date_trunc('{unit}', order_purchase_timestamp) + INTERVAL 1 {unit} AS window_end
FROM feed
WHERE product_category IS NOT NULL AND price IS NOT NULL
GROUP BY product_category, date_trunc('{unit}', order_purchase_timestamp)""")


def kpis(feed: str, unit: str = "minute", minutes: float = 1.0) -> str:
    # HALF_UP average in integer cents: (2c + n) // (2n), c >= 0.
    return with_feed(feed, f"""
SELECT CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100 AS average_order_value,
       n / {minutes} AS orders_per_minute,
       n AS total_orders,
       CAST(cents AS DOUBLE) / 100 AS total_revenue,
       ws AS window_start, ws + INTERVAL 1 {unit} AS window_end
FROM (SELECT date_trunc('{unit}', order_purchase_timestamp) AS ws, count(*) AS n,
             CAST(sum((coalesce(price, 0) + coalesce(freight_value, 0)) * 100) AS HUGEINT) AS cents
      FROM feed WHERE price IS NOT NULL GROUP BY 1)""")


def price_alerts_body(threshold: str) -> str:
    return f"""
SELECT 'PRICE_ANOMALY' AS alert_type, seller_id AS entity_id,
       'Order price ' || CAST(price AS VARCHAR) || ' exceeds threshold {threshold}' AS description,
       CAST(price AS DOUBLE) AS value, order_purchase_timestamp AS detected_at
FROM feed WHERE price > {threshold}"""


def burst_alerts_body(min_count: int, span_sql: str, span_words: str) -> str:
    # Pairwise formulation: K(e) = #events f of the customer with rank(f) <= rank(e)
    # and t_f > t_e - span; then one alert per length min_count..K.
    return f"""
, ranked AS (
  SELECT customer_id, order_purchase_timestamp AS ts,
         row_number() OVER (PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id, product_id) AS rn
  FROM feed WHERE customer_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL),
ends AS (
  SELECT e.customer_id, e.ts, count(*) AS k
  FROM ranked e JOIN ranked f
    ON f.customer_id = e.customer_id AND f.rn <= e.rn AND f.ts > e.ts - INTERVAL {span_sql}
  GROUP BY e.customer_id, e.ts, e.rn
  HAVING count(*) >= {min_count})
SELECT 'SUSPICIOUS_FREQUENCY' AS alert_type, customer_id AS entity_id,
       CAST(len AS VARCHAR) || ' orders in less than {span_words}' AS description,
       CAST(NULL AS DOUBLE) AS value, ts AS detected_at
FROM ends, range({min_count}, k + 1) r(len)"""


def burst_alerts(feed: str, min_count: int, span_sql: str, span_words: str) -> str:
    return with_feed(feed, "").rstrip() + burst_alerts_body(min_count, span_sql, span_words)


def epoch_text(ts: str) -> str:
    return f"printf('%d.%09d', epoch_us({ts}) // 1000000, (epoch_us({ts}) % 1000000) * 1000)"


def cents_text(cents: str) -> str:
    return f"printf('%d.%02d', ({cents}) // 100, ({cents}) % 100)"


def revenue_json(feed: str) -> str:
    return with_feed(feed, f"""
, r AS (
  SELECT product_category, sum(coalesce(price, 0) + coalesce(freight_value, 0)) AS total, count(*) AS n,
         date_trunc('minute', order_purchase_timestamp) AS ws
  FROM feed WHERE product_category IS NOT NULL AND price IS NOT NULL GROUP BY 1, 4)
SELECT CAST(NULL AS VARCHAR) AS key,
       '{{"productCategory":' || to_json(product_category) || ',"totalRevenue":' || CAST(total AS VARCHAR)
       || ',"orderCount":' || CAST(n AS VARCHAR) || ',"windowStart":' || {epoch_text('ws')}
       || ',"windowEnd":' || {epoch_text("ws + INTERVAL 1 MINUTE")} || '}}' AS value
FROM r""")


def kpi_json(feed: str) -> str:
    return with_feed(feed, f"""
, k AS (
  SELECT date_trunc('minute', order_purchase_timestamp) AS ws, count(*) AS n,
         CAST(sum((coalesce(price, 0) + coalesce(freight_value, 0)) * 100) AS HUGEINT) AS cents
  FROM feed WHERE price IS NOT NULL GROUP BY 1)
SELECT CAST(NULL AS VARCHAR) AS key,
       '{{"averageOrderValue":' || {cents_text('(2 * cents + n) // (2 * n)')}
       || ',"ordersPerMinute":' || CAST(CAST(n AS DOUBLE) AS VARCHAR)
       || ',"totalOrders":' || CAST(n AS VARCHAR) || ',"totalRevenue":' || {cents_text('cents')}
       || ',"windowStart":' || {epoch_text('ws')} || ',"windowEnd":' || {epoch_text("ws + INTERVAL 1 MINUTE")}
       || '}}' AS value
FROM k""")


def price_alert_json(feed: str, threshold: str) -> str:
    return with_feed(feed, f"""
SELECT CAST(NULL AS VARCHAR) AS key,
       '{{"alertType":"PRICE_ANOMALY","entityId":' || to_json(seller_id)
       || ',"description":"Order price ' || CAST(price AS VARCHAR) || ' exceeds threshold {threshold}"'
       || ',"value":' || CAST(price AS VARCHAR) || ',"detectedAt":' || {epoch_text('order_purchase_timestamp')}
       || '}}' AS value
FROM feed WHERE price > {threshold}""")


def revenue_table_rows(feed: str, unit: str = "minute") -> str:
    return with_feed(feed, f"""
SELECT product_category,
       CAST(CAST(sum(coalesce(price, 0) + coalesce(freight_value, 0)) AS DECIMAL(12,2)) AS DOUBLE) AS total_revenue,
       count(*) AS order_count,
       date_trunc('{unit}', order_purchase_timestamp) AS window_start,
       date_trunc('{unit}', order_purchase_timestamp) + INTERVAL 1 {unit} AS window_end,
       strftime(date_trunc('{unit}', order_purchase_timestamp), '%Y-%m-%d') AS window_date
FROM feed
WHERE product_category IS NOT NULL AND price IS NOT NULL
GROUP BY product_category, date_trunc('{unit}', order_purchase_timestamp)""")


def decoded_events(feed: str) -> str:
    # The producer writes whole seconds, so decoded times are truncated to the second.
    return with_feed(feed, """
SELECT order_id, customer_id, order_status, date_trunc('second', order_purchase_timestamp) AS order_purchase_timestamp,
       product_id, seller_id, product_category, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value
FROM feed WHERE product_category IS NOT NULL""")


def decode_outcomes(feed: str) -> str:
    return with_feed(feed, """
SELECT CASE WHEN product_category IS NULL THEN 'malformed' ELSE 'valid' END AS outcome, count(*) AS messages
FROM feed GROUP BY 1""")


def with_text(sql: str, column: str) -> str:
    """The query's rows with one amount as text of two decimals as well."""
    return f"SELECT *, CAST(CAST({column} AS DECIMAL(12,2)) AS VARCHAR) AS {column}_text FROM ({sql}) q"


def wide_price_alerts(feed: str) -> str:
    """Alerts of prices changed as in the query: kept with all their digits, unless the message is dropped."""
    return with_feed(feed, """
, wide AS (
  SELECT *, CAST(order_id AS BIGINT) AS n,
         CAST(price AS DECIMAL(27,6)) + CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN 0.004 ELSE 0 END
         + CASE WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN 12345678900 ELSE 0 END AS p
  FROM feed)
SELECT 'PRICE_ANOMALY' AS alert_type, seller_id AS entity_id,
       'Order price ' || CAST(CAST(floor(p * 100) AS BIGINT) // 100 AS VARCHAR) || '.'
       || lpad(CAST(CAST(floor(p * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') || CASE WHEN n % 3 = 0 THEN '4' ELSE '' END
       || ' exceeds threshold 400' AS description,
       CAST(p AS DOUBLE) AS value, date_trunc('second', order_purchase_timestamp) AS detected_at,
       CAST(CAST(p AS DECIMAL(27,6)) AS VARCHAR) AS value_text
FROM wide WHERE p > 400 AND n % 7 <> 0""")


def csv_rows(feed: str) -> str:
    return with_feed(feed, f"""
, changed AS (
  SELECT * REPLACE (CASE WHEN CAST(product_id AS BIGINT) % 13 = 0 THEN 0 ELSE price END AS price,
                    product_category || ', "new"' || chr(10) || 'line' AS product_category)
  FROM feed WHERE CAST(order_id AS BIGINT) % 11 <> 0)
SELECT {EVENT_COLUMNS} FROM changed""")


def positions(feed: str) -> str:
    return with_feed(feed, f"""
SELECT {EVENT_COLUMNS}, row_number() OVER (ORDER BY order_purchase_timestamp NULLS FIRST, order_id NULLS FIRST,
       product_id NULLS FIRST, seller_id NULLS FIRST, price NULLS FIRST) - 1 AS position FROM feed""")


def late_revenue(feed: str) -> str:
    """Even events, and the odd ones in windows that were still open when they came: the watermark then was
    the largest even event time (in ms) less 10 s."""
    return with_feed(feed, """
, mark AS (SELECT (epoch_us(max(order_purchase_timestamp)) // 1000 - 10000) * 1000 AS us FROM feed WHERE CAST(order_id AS BIGINT) % 2 = 0),
seen AS (
  SELECT * FROM feed WHERE CAST(order_id AS BIGINT) % 2 = 0
  OR epoch_us(date_trunc('minute', order_purchase_timestamp) + INTERVAL 1 MINUTE) > (SELECT us FROM mark))
SELECT product_category, CAST(sum(coalesce(price, 0) + coalesce(freight_value, 0)) AS DOUBLE) AS total_revenue,
       count(*) AS order_count, date_trunc('minute', order_purchase_timestamp) AS window_start,
       date_trunc('minute', order_purchase_timestamp) + INTERVAL 1 MINUTE AS window_end
FROM seen WHERE product_category IS NOT NULL AND price IS NOT NULL
GROUP BY product_category, date_trunc('minute', order_purchase_timestamp)""")


def lateness(feed: str) -> str:
    """Groups of odd events (valid or not) in windows that ended at or before the watermark of the even ones, whole milliseconds."""
    return with_feed(feed, """
, mark AS (SELECT epoch_us(max(order_purchase_timestamp)) // 1000 - 10000 AS ms FROM feed WHERE CAST(order_id AS BIGINT) % 2 = 0),
late AS (
  SELECT DISTINCT product_category, date_trunc('minute', order_purchase_timestamp) AS ws FROM feed
  WHERE CAST(order_id AS BIGINT) % 2 = 1
    AND epoch_us(date_trunc('minute', order_purchase_timestamp) + INTERVAL 1 MINUTE) <= (SELECT ms * 1000 FROM mark)),
groups AS (SELECT 'revenue' AS query, (SELECT count(*) FROM late) AS n UNION ALL SELECT 'kpi', (SELECT count(DISTINCT ws) FROM late))
SELECT query, n AS late_rows, CASE WHEN n > 0 THEN 1 ELSE 0 END AS late_batches,
       CASE WHEN n > 0 THEN (SELECT ms FROM mark) END AS watermark_ms
FROM groups""")


def record_counts(feed: str) -> str:
    """Records in (the events and the end marker) and out (windows, alerts) of the replays. The alert job reads its messages twice,
    for bursts and for prices (the filter on prices skips the end marker); an event without a category is a bad message there, and times are whole seconds."""
    return with_feed(feed, """
, decoded AS (
  SELECT customer_id, date_trunc('second', order_purchase_timestamp) AS ts, order_id, product_id, price
  FROM feed WHERE product_category IS NOT NULL),
ranked AS (
  SELECT customer_id, ts, row_number() OVER (PARTITION BY customer_id ORDER BY ts, order_id, product_id) AS rn
  FROM decoded),
ends AS (
  SELECT count(*) AS k
  FROM ranked e JOIN ranked f ON f.customer_id = e.customer_id AND f.rn <= e.rn AND f.ts > e.ts - INTERVAL 1 DAY
  GROUP BY e.customer_id, e.ts, e.rn HAVING count(*) >= 3)
, n AS (SELECT CAST(count(*) + 1 AS DOUBLE) AS n FROM feed)
SELECT 'revenue' AS query, 'numInputRows' AS name, n AS value FROM n
UNION ALL SELECT 'kpi', 'numInputRows', n FROM n
UNION ALL SELECT 'revenue', 'recordsOut', CAST(count(DISTINCT (product_category, date_trunc('minute', order_purchase_timestamp))) AS DOUBLE)
  FROM feed WHERE product_category IS NOT NULL AND price IS NOT NULL
UNION ALL SELECT 'kpi', 'recordsOut', CAST(count(DISTINCT date_trunc('minute', order_purchase_timestamp)) AS DOUBLE)
  FROM feed WHERE price IS NOT NULL
UNION ALL SELECT 'alerts', 'numInputRows', 2 * n - 1 FROM n
UNION ALL SELECT 'alerts', 'recordsOut', CAST((SELECT count(*) FROM decoded WHERE price > 400) + (SELECT coalesce(sum(k - 2), 0) FROM ends) AS DOUBLE)""")


def quarantine_rows(feed: str) -> str:
    return feed_rows(feed, "product_category IS NULL OR price IS NULL OR order_purchase_timestamp IS NULL",
                     extra=", CASE WHEN order_purchase_timestamp IS NULL THEN 'no purchase time' "
                           "WHEN product_category IS NULL AND price IS NULL THEN 'no category, no price' "
                           "WHEN product_category IS NULL THEN 'no category' ELSE 'no price' END AS quarantined_reason")


def kpi_distribution(feed: str, capacity: int, quantiles: tuple[float, ...], names: list[str]) -> str:
    qs = ",\n       ".join(f"coalesce(CAST(quantile_disc(v, {q}) AS DOUBLE), 0) AS {n}" for q, n in zip(quantiles, names))
    return with_feed(feed, f"""
, k AS (
  SELECT date_trunc('minute', order_purchase_timestamp) AS ws, count(*) AS n,
         CAST(sum((coalesce(price, 0) + coalesce(freight_value, 0)) * 100) AS HUGEINT) AS cents
  FROM feed WHERE price IS NOT NULL GROUP BY 1),
vals AS (SELECT ws, CAST((((2 * cents + n) // (2 * n)) + 50) // 100 AS BIGINT) AS v FROM k),
kept AS (SELECT v FROM vals ORDER BY ws DESC LIMIT {capacity})
SELECT (SELECT count(*) FROM vals) AS count,
       count(v) AS size,
       coalesce(min(v), 0) AS min, coalesce(max(v), 0) AS max,
       round(coalesce(avg(v), 0), 6) AS mean,
       round(CASE WHEN count(v) >= 2 THEN stddev_pop(v) ELSE 0 END, 6) AS stddev,
       {qs}
FROM kept""")


def stream_metrics(feed: str) -> str:
    """Counter totals of the metric replays, from the tables: windows of the revenue and KPI
    replays, the order count of the last KPI window, and for the alert replay from JSON messages
    (events of type 'error' are malformed; decoded times are whole seconds): price alerts, burst
    alerts and decoding errors."""
    return with_feed(feed, """
, rev AS (
  SELECT date_trunc('minute', order_purchase_timestamp) + INTERVAL 1 MINUTE AS we
  FROM feed GROUP BY product_category, date_trunc('minute', order_purchase_timestamp)
  HAVING count(*) FILTER (WHERE product_category IS NOT NULL AND price IS NOT NULL) > 0),
kpi AS (
  SELECT date_trunc('minute', order_purchase_timestamp) AS ws, count(*) FILTER (WHERE price IS NOT NULL) AS n
  FROM feed GROUP BY 1 HAVING count(*) FILTER (WHERE price IS NOT NULL) > 0),
decoded AS (
  SELECT customer_id, date_trunc('second', order_purchase_timestamp) AS ts, order_id, product_id, price
  FROM feed WHERE product_category IS NOT NULL),
ranked AS (
  SELECT customer_id, ts, row_number() OVER (PARTITION BY customer_id ORDER BY ts, order_id, product_id) AS rn
  FROM decoded),
ends AS (
  SELECT e.ts, count(*) AS k
  FROM ranked e JOIN ranked f ON f.customer_id = e.customer_id AND f.rn <= e.rn AND f.ts > e.ts - INTERVAL 1 DAY
  GROUP BY e.customer_id, e.ts, e.rn HAVING count(*) >= 3)
SELECT 'revenue' AS query, 'windowsEmitted' AS name,
       CAST((SELECT count(*) FROM rev) AS DOUBLE) AS value
UNION ALL SELECT 'kpi', 'kpiWindowsEmitted', CAST((SELECT count(*) FROM kpi) AS DOUBLE)
UNION ALL SELECT 'kpi', 'lastWindowOrderCount', CAST((SELECT max_by(n, ws) FROM kpi) AS DOUBLE)
UNION ALL SELECT 'alerts', 'priceAnomalyAlertsEmitted', CAST((SELECT count(*) FROM decoded WHERE price > 400) AS DOUBLE)
UNION ALL SELECT 'alerts', 'suspiciousFrequencyAlertsEmitted',
       CAST((SELECT coalesce(sum(k - 2), 0) FROM ends) AS DOUBLE)
UNION ALL SELECT 'alerts', 'deserializationErrors', CAST((SELECT count(*) FROM feed WHERE product_category IS NULL) AS DOUBLE)""")


def all_alerts_json(feed: str, min_count: int, span_sql: str, span_words: str, threshold: str) -> str:
    """Burst alerts (value null) and price alerts as JSON text."""
    alerts = (with_feed(feed, "").rstrip() + burst_alerts_body(min_count, span_sql, span_words)
              + "\nUNION ALL" + price_alerts_body(threshold).replace("CAST(price AS DOUBLE) AS value",
                                                                   "CAST(price AS VARCHAR) AS value"))
    alerts = alerts.replace("CAST(NULL AS DOUBLE) AS value", "CAST(NULL AS VARCHAR) AS value")
    return f"""
SELECT CAST(NULL AS VARCHAR) AS key,
       '{{"alertType":' || to_json(alert_type) || ',"entityId":' || to_json(entity_id)
       || ',"description":' || to_json(description) || ',"value":' || coalesce(value, 'null')
       || ',"detectedAt":' || {epoch_text('detected_at')} || '}}' AS value
FROM ({alerts}) a"""
