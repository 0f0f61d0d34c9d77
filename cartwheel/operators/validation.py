"""Event filters.

P2  priced events (KPI input; a null category is fine)
P3  valid / invalid split of the revenue job: category and price both present. Spark has no
    side output, so the split is two complementary filters over the same input; in a stream
    they are two queries with their own checkpoints (see ``cartwheel.streaming.jobs``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_valid(category: str = "product_category", price: str = "price") -> Column:
    return F.col(category).isNotNull() & F.col(price).isNotNull()


def valid_events(events: DataFrame) -> DataFrame:
    return events.where(is_valid())


def invalid_events(events: DataFrame) -> DataFrame:
    """Exact complement of ``valid_events`` (a null-safe negation)."""
    return events.where(~is_valid())


def priced_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("price").isNotNull())
