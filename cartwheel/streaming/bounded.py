"""The end of a bounded input.

A bounded stream ends with windows still open and events not yet judged, as nothing moves the
watermark past them. An end marker does: an order event with a time beyond everything that is open
and nothing else in it, so no operator emits it (no category, no price, no customer). It comes from a
folder of its own, united with the orders ahead of the watermark.

If the input is read in one micro-batch the marker may be there from the start. Otherwise it is written
after the input was read, and the query started once more on the same checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import span_microseconds
from cartwheel.schemas import EVENT_TIME, ORDER_EVENT
from cartwheel.session import make_folder


def with_end(orders: DataFrame, folder: str) -> DataFrame:
    """The stream of orders and the end marker that is or will be in ``folder``."""
    spark = orders.sparkSession
    make_folder(spark, folder)
    return orders.unionByName(spark.readStream.schema(ORDER_EVENT).parquet(folder))


def write_end(last_event: DataFrame, folder: str, *spans: str) -> None:
    """Write the marker: the largest event time of ``last_event`` (a batch of order events) plus the given spans (window,
    burst span, watermark delay) and a second. Without events there is nothing to end."""
    after = sum(span_microseconds(s) for s in spans) + 1_000_000
    time = F.timestamp_micros(F.unix_micros(F.max(EVENT_TIME)) + F.lit(after))
    end = last_event.agg(time.alias(EVENT_TIME)).where(F.col(EVENT_TIME).isNotNull())
    fields = [F.col(f.name) if f.name == EVENT_TIME else F.lit(None).cast(f.dataType).alias(f.name) for f in ORDER_EVENT.fields]
    end.select(*fields).write.mode("append").parquet(folder)
