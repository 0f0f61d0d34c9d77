"""Order enrichment: orders x items x products -> one order event per item.

J1  orders LEFT items on order_id (an order without items gives one event with null item fields)
J2  items LEFT products on product_id (a missing product gives a null category)
P7  orders with a missing or unparsable purchase time are skipped (done by the CSV source)
O1  optional global sort by purchase time, for writing replay files

Scale notes
* Product dedup (``max`` of the non-empty categories per product) is a hash aggregate on
  product_id; its output partitioning is reused by the item join, so the product side is
  shuffled once. Spark/AQE broadcasts it only when its measured size is under the broadcast
  threshold.
* The one-to-many LEFT join is written as ``inner + anti``: AQE can split a hot order key
  on both sides of an inner join, while a LEFT OUTER join can only be split on its left
  side. The anti side probes the *distinct* item order ids, which are pre-aggregated
  map-side, so a hot order id never lands whole in one task there either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_products(products: DataFrame) -> DataFrame:
    """One row per product_id: the category of the last row that has one, by ``product_position``; in a table, whose rows have
    no order, the greatest category. Null when there is none."""
    category = F.nullif("product_category", F.lit(""))
    if "product_position" in products.columns:
        last = F.max(F.when(category.isNotNull(), F.struct("product_position", category.alias("category"))))
        return products.groupBy("product_id").agg(last.alias("last")).select("product_id", F.col("last.category").alias("product_category"))
    return products.select("product_id", category.alias("product_category")).groupBy("product_id").agg(F.max("product_category").alias("product_category"))


def orders_left_items(orders: DataFrame, items: DataFrame, key: str = "order_id") -> DataFrame:
    """orders LEFT OUTER JOIN items on ``key``, as matched rows plus unmatched orders.

    Both joins take the same non-null-key orders, so their shuffle of the orders is one exchange
    (reused); orders with a null key match nothing and are passed through on their own (a
    filter that Parquet null counts mostly answer without reading data)."""
    keyed = orders.where(F.col(key).isNotNull())
    matched = keyed.join(items, key, "inner")
    unmatched = keyed.join(items.select(key).distinct(), key, "left_anti")
    null_keys = orders.where(F.col(key).isNull())
    return (matched.unionByName(unmatched, allowMissingColumns=True)
                   .unionByName(null_keys, allowMissingColumns=True))


POSITIONS = ["order_position", "item_position"]


def enrich_orders(orders: DataFrame, items: DataFrame, products: DataFrame, sort: bool = False, positions: bool = False) -> DataFrame:
    """orders(order_id, customer_id, order_status, order_purchase_timestamp)
    x items(order_id, product_id, seller_id, price, freight_value)
    x products(product_id, product_category) -> order events.

    Inputs from files may have their positions (order_position, item_position, product_position), which break ties as the
    input does; ``positions`` keeps the first two in the result."""
    priced_items = items.join(dedup_products(products), "product_id", "left")
    events = orders_left_items(orders, priced_items)
    if sort:
        events = sort_by_purchase_time(events)
    return events if positions else events.drop(*POSITIONS)


def time_order(events: DataFrame) -> list[str]:
    """Purchase time, then the place in the input where it is known (a stable sort), else (order_id, product_id)."""
    known = [c for c in POSITIONS if c in events.columns]
    return ["order_purchase_timestamp", *(known or ["order_id", "product_id"])]


def sort_by_purchase_time(events: DataFrame) -> DataFrame:
    """Global order by purchase time: range partitioned, so every task writes one contiguous time slice."""
    return events.orderBy(*time_order(events))


def with_position(events: DataFrame, folder: str) -> DataFrame:
    """``position`` (from 0) of each event in the order by purchase time, ties by (order_id, product_id, seller_id, price).

    The range partitions are written to ``folder`` once, so their bounds are fixed; each then numbers its own
    rows from the running sum of the partitions' counts (one row per partition)."""
    order = ["order_purchase_timestamp", "order_id", "product_id", "seller_id", "price"]
    (events.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(folder))
    ranged = events.sparkSession.read.parquet(folder)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(starts, "_part").withColumn("position", F.col("_first") + inside - 1).drop("_part", "_first")
