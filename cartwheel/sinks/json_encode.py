"""K4: result records as JSON messages.

Field names are the record properties in camelCase and declaration order, nulls are written,
decimals have two digits (HALF_UP), instants are decimal epoch seconds with nine fraction digits
(``1704067200.000000000``). Output columns: key (nullable), value (JSON text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.columns import epoch_seconds

JSON_OPTIONS = {"ignoreNullFields": "false"}

# JSON property names of each result record, in output order.
REVENUE_FIELDS = [("productCategory", "product_category"), ("totalRevenue", "total_revenue"),
                  ("orderCount", "order_count"), ("windowStart", "window_start"), ("windowEnd", "window_end")]
KPI_FIELDS = [("averageOrderValue", "average_order_value"), ("ordersPerMinute", "orders_per_minute"),
              ("totalOrders", "total_orders"), ("totalRevenue", "total_revenue"),
              ("windowStart", "window_start"), ("windowEnd", "window_end")]
ALERT_FIELDS = [("alertType", "alert_type"), ("entityId", "entity_id"), ("description", "description"),
                ("value", "value"), ("detectedAt", "detected_at")]
INSTANT_COLUMNS = {"window_start", "window_end", "detected_at"}


def _encode(df: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}

    def part(c):
        if c in INSTANT_COLUMNS:
            return epoch_seconds(F.col(c))
        return F.round(c, 2) if isinstance(types[c], T.DecimalType) else F.col(c)

    parts = [part(c).alias(name) for name, c in fields]
    return df.select(F.lit(None).cast("string").alias("key"),
                     F.to_json(F.struct(*parts), JSON_OPTIONS).alias("value"))


def revenue_json(revenue: DataFrame) -> DataFrame:
    return _encode(revenue, REVENUE_FIELDS)


def kpi_json(kpis: DataFrame) -> DataFrame:
    return _encode(kpis, KPI_FIELDS)


def alert_json(alerts: DataFrame) -> DataFrame:
    return _encode(alerts, ALERT_FIELDS)
