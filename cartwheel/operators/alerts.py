"""P5/P6 price anomalies and U1 the union of both alert kinds."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.config import DEFAULT_PRICE_ANOMALY_THRESHOLD
from cartwheel.functions.columns import amount_text
from cartwheel.schemas import ALERT_TABLE, AMOUNT, EVENT_TIME, PRICE_ANOMALY, PRICE_DESCRIPTION

ALERT_COLUMNS = [f.name for f in ALERT_TABLE.fields]


def price_anomaly_alerts(events: DataFrame, threshold: Decimal | str | int = DEFAULT_PRICE_ANOMALY_THRESHOLD) -> DataFrame:
    """One alert per event whose price is strictly above ``threshold`` (a null price never alerts).

    entity = seller, value = price, detected_at = event time. Stateless, so in a stream it
    sees late events too (it must not sit behind a watermark filter)."""
    t = Decimal(str(threshold))
    return (events
            .where(F.col("price") > F.lit(t))
            .select(F.lit(PRICE_ANOMALY).alias("alert_type"),
                    F.col("seller_id").alias("entity_id"),
                    F.concat(F.lit(PRICE_DESCRIPTION[0]), amount_text(F.col("price")),
                             F.lit(PRICE_DESCRIPTION[1] + str(t))).alias("description"),
                    F.col("price").cast(AMOUNT).alias("value"),
                    F.col(EVENT_TIME).alias("detected_at")))


def union_alerts(*streams: DataFrame) -> DataFrame:
    """Bag union (UNION ALL) by column name; no shuffle."""
    out = streams[0].select(*ALERT_COLUMNS)
    for s in streams[1:]:
        out = out.unionByName(s.select(*ALERT_COLUMNS))
    return out
