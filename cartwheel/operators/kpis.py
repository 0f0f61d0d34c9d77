"""A2-A5: global KPIs per tumbling event-time window.

The original job gathers every event on one task (``windowAll``). Here the window is the group
key of a two-phase aggregate: partial count/sum per task, then one final row per window, so no
task ever sees more than one partial row per window from each input task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.config import DEFAULT_WINDOW
from cartwheel.functions.columns import event_value, half_up_average
from cartwheel.operators.validation import priced_events
from cartwheel.schemas import EVENT_TIME


def realtime_kpis(events: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """average_order_value (HALF_UP, 2 decimals), orders_per_minute, total_orders, total_revenue,
    window_start, window_end over priced events (P2). Windows without priced events produce no
    row (A5). As in the revenue aggregate, a stream tests the price inside the aggregate, so that
    its watermark still sees every event; a batch filters first."""
    priced = F.col("price").isNotNull()
    if not events.isStreaming:
        events = priced_events(events)
    agg = (events.groupBy(F.window(EVENT_TIME, window).alias("w"))
                 .agg(F.count_if(priced).alias("total_orders"),
                      F.sum(F.when(priced, event_value())).alias("total_revenue"))
                 .where(F.col("total_orders") > 0))
    minutes = (F.unix_micros(F.col("w.end")) - F.unix_micros(F.col("w.start"))) / F.lit(60_000_000.0)
    return agg.select(
        half_up_average(F.col("total_revenue"), F.col("total_orders")).alias("average_order_value"),
        (F.col("total_orders") / minutes).alias("orders_per_minute"),
        "total_orders", "total_revenue",
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
