"""Revenue per product category and tumbling event-time window.

``groupBy(window, category).agg(sum, count)`` is a two-phase hash aggregate: each task
pre-aggregates its rows (one row per window and category it saw) before the shuffle, so a hot
category or window costs one partial row per task, not its rows. Windows are epoch-aligned
``[start, end)``, the same as the engine the jobs were written for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.config import DEFAULT_WINDOW
from cartwheel.functions.columns import event_value
from cartwheel.operators.validation import is_valid, valid_events
from cartwheel.schemas import EVENT_TIME


def revenue_by_category(events: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """product_category, total_revenue, order_count, window_start, window_end over valid events
    (category and price present, P3). ``order_count`` counts events (one per order item).

    In a stream, validation is part of the aggregate (conditional sum/count, then groups without
    valid events are dropped) rather than a filter in front of it: Catalyst pushes such a filter
    below the watermark, which would then advance on valid events only, while event time must
    advance with every decoded event. A batch filters first, so that the test reaches the scans
    and joins."""
    valid = is_valid()
    if not events.isStreaming:
        events = valid_events(events)
    return (events
            .groupBy(F.window(EVENT_TIME, window).alias("w"), F.col("product_category"))
            .agg(F.sum(F.when(valid, event_value())).alias("total_revenue"),
                 F.count_if(valid).alias("order_count"))
            # a group with a null category has no valid events, so this also drops it; a
            # predicate on the category itself would be pushed below the watermark again
            .where(F.col("order_count") > 0)
            .select("product_category", "total_revenue", "order_count",
                    F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")))
