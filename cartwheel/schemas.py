"""Record schemas: the order event (input) and the three result records."""

from pyspark.sql import types as T

# Result tables hold money; inputs keep every digit they come with (27 digits, 6 after the point,
# which leaves 11 digits for sums).
MONEY = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(27, 6)

# Order event, one per order item (JSON field names).
ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_purchase_timestamp", T.TimestampType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("seller_id", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("price", AMOUNT),
    T.StructField("freight_value", AMOUNT),
])
ORDER_EVENT_COLUMNS = [f.name for f in ORDER_EVENT.fields]
EVENT_TIME = "order_purchase_timestamp"

# Result tables (snake_case column names, all nullable).
REVENUE_TABLE = T.StructType([
    T.StructField("product_category", T.StringType()),
    T.StructField("total_revenue", MONEY),
    T.StructField("order_count", T.LongType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
])
KPI_TABLE = T.StructType([
    T.StructField("average_order_value", MONEY),
    T.StructField("orders_per_minute", T.DoubleType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_revenue", MONEY),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
])
ALERT_TABLE = T.StructType([
    T.StructField("alert_type", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("value", MONEY),
    T.StructField("detected_at", T.TimestampType()),
])

# Alert type names and the parts of the descriptions.
SUSPICIOUS_FREQUENCY = "SUSPICIOUS_FREQUENCY"
PRICE_ANOMALY = "PRICE_ANOMALY"
PRICE_DESCRIPTION = ("Order price ", " exceeds threshold ")
BURST_DESCRIPTION = " orders in less than "
