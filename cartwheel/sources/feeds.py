"""Order-event feeds over the driver tables, both in the order-event schema.

* item feed: orders LEFT items LEFT parts, one event per item (the enrichment's join shape);
* event feed: the ``events`` table mapped column by column.

Timestamps in the tables are timestamp_ntz (UTC wall clock); they are cast to timestamp in a
UTC session so that watermarks accept them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.enrichment import enrich_orders
from cartwheel.schemas import AMOUNT, MONEY, ORDER_EVENT_COLUMNS
from cartwheel.session import use_utc
from cartwheel.sources.tables import read_table


def event_feed_from(events: DataFrame) -> DataFrame:
    """Map rows of ``events`` (event_id, ts, user_id, event_type, value, props) to order events."""
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.col("ts").cast("timestamp").alias("order_purchase_timestamp"),
        (F.col("event_id") % 200).cast("string").alias("product_id"),
        (F.col("event_id") % 50).cast("string").alias("seller_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("product_category"),
        F.when(F.col("event_type") != "signup", F.col("value").cast(MONEY).cast(AMOUNT)).alias("price"),
        F.get_json_object("props", "$.k").cast(MONEY).cast(AMOUNT).alias("freight_value"),
    )


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return event_feed_from(events)


def item_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    # Keys stay bigint through the joins (cheaper hashing and sorting); cast to text at the end.
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("timestamp").alias("order_purchase_timestamp"),
    )
    items = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_extendedprice").cast(MONEY).cast(AMOUNT).alias("price"),
        F.col("l_quantity").cast(MONEY).cast(AMOUNT).alias("freight_value"),
    )
    products = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category"),
    )
    events = enrich_orders(orders, items, products, sort=False)
    return events.select(*[F.col(c).cast("string").alias(c) if c in ("order_id", "product_id") else F.col(c)
                           for c in ORDER_EVENT_COLUMNS])


FEEDS = {"item": item_feed, "event": event_feed}
