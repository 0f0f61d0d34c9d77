"""M1-M7: job metrics as data.

Counters and gauges are ``observe`` aggregates attached to the result streams; their per-batch
values arrive in the progress report of each micro-batch and a counter is the running sum.
``MetricsLog`` is a listener: it gets every report, of however many micro-batches (a query itself
keeps only the last hundred), turns it into rows (query, batch, name, value), with records in and out
and their rates (M7), the watermark of each batch and what its state operators dropped behind it (T3), and appends them
to a metrics table, or keeps them for the caller.
The value distribution (M4) is the A6 report over the KPI table; decoding errors (M6) are
observed by ``decode_order_messages(..., observe=True)``.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from cartwheel.schemas import PRICE_ANOMALY, SUSPICIOUS_FREQUENCY

METRIC_ROW = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def observe_revenue(revenue: DataFrame) -> DataFrame:
    return revenue.observe("revenue", F.count(F.lit(1)).alias("windowsEmitted"), F.count(F.lit(1)).alias("recordsOut"))


def observe_kpis(kpis: DataFrame) -> DataFrame:
    return kpis.observe("kpi", F.count(F.lit(1)).alias("kpiWindowsEmitted"),
                        F.max_by("total_orders", "window_start").alias("lastWindowOrderCount"),
                        F.count(F.lit(1)).alias("recordsOut"))


def observe_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.observe("alerts",
                          F.count_if(F.col("alert_type") == PRICE_ANOMALY).alias("priceAnomalyAlertsEmitted"),
                          F.count_if(F.col("alert_type") == SUSPICIOUS_FREQUENCY).alias("suspiciousFrequencyAlertsEmitted"),
                          F.count(F.lit(1)).alias("recordsOut"))


def progress_rows(query_name: str, progresses) -> list[tuple]:
    """(query, batch_id, name, value) for every observed metric and rate of each progress report.

    Progress reports are small driver-side metadata (one per micro-batch), not data. A batch without an
    ``observe`` result emitted nothing."""
    rows = []
    for p in progresses:
        batch = int(p.batchId)
        rows.append((query_name, batch, "numInputRows", float(p.numInputRows)))
        rows.append((query_name, batch, "inputRowsPerSecond", float(p.inputRowsPerSecond or 0.0)))
        rows.append((query_name, batch, "processedRowsPerSecond", float(p.processedRowsPerSecond or 0.0)))
        seconds = (p.durationMs or {}).get("triggerExecution", 0) / 1000
        if p.stateOperators:
            rows.append((query_name, batch, LATE, float(sum(s.numRowsDroppedByWatermark for s in p.stateOperators))))
        if mark := (p.eventTime or {}).get("watermark"):
            rows.append((query_name, batch, WATERMARK, datetime.fromisoformat(mark).timestamp() * 1000))
        for obs_name, row in (p.observedMetrics or {}).items():
            for k, v in row.asDict().items():
                if v is not None:
                    rows.append((query_name, batch, k, float(v)))
                if k == "recordsOut":
                    rows.append((query_name, batch, "recordsOutPerSecond", float(v or 0) / seconds if seconds else 0.0))
    return rows


class MetricsLog(StreamingQueryListener):
    """Metric rows of all queries of a session, from when it is added to ``spark.streams``.

    With ``path`` each report is appended to a Parquet table there; without, the rows stay in ``rows``
    by query name."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path
        self.rows: dict[str, list[tuple]] = {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        name = event.progress.name or str(event.progress.id)
        rows = progress_rows(name, [event.progress])
        if self.path:
            metrics_frame(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)
        else:
            self.rows.setdefault(name, []).extend(rows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait_for(self, query, seconds: float = 60.0) -> None:
        """Until every report of a query that has ended is here (reports arrive in the background)."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} was reported")


def metrics_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, METRIC_ROW)


# Metric names that are gauges (last value counts); observed counters add up.
GAUGES = ("lastWindowOrderCount",)
RATES = ("inputRowsPerSecond", "processedRowsPerSecond", "recordsOutPerSecond")
RECORDS = ("numInputRows", "recordsOut")

# What a state operator dropped: its input rows. Those of a windowed aggregate are groups (window and key) with any number of events,
# as the events of a micro-batch are aggregated before they come to the state.
LATE = "lateRowsDropped"
WATERMARK = "watermarkEpochMillis"


def counters(metrics: DataFrame) -> DataFrame:
    """query, name, value: counters summed over batches, gauges at their last reported value
    (rates, record counts and lateness excluded)."""
    observed = metrics.where(~F.col("name").isin(*RATES, *RECORDS, LATE, WATERMARK))
    is_gauge = F.col("name").isin(*GAUGES)
    return (observed.groupBy("query", "name")
            .agg(F.when(F.first(is_gauge), F.max_by("value", "batch_id")).otherwise(F.sum("value")).alias("value")))


def rates(metrics: DataFrame) -> DataFrame:
    """M7: records and records per second of each micro-batch."""
    return metrics.where(F.col("name").isin(*RATES, *RECORDS))


def record_counts(metrics: DataFrame) -> DataFrame:
    """query, name, value: all records in and out of each query."""
    return metrics.where(F.col("name").isin(*RECORDS)).groupBy("query", "name").agg(F.sum("value").alias("value"))


def lateness(metrics: DataFrame) -> DataFrame:
    """Query, late_rows, late_batches, watermark_ms: what the state operators of each query dropped, in how many micro-batches, and the
    largest watermark (milliseconds) that such a batch judged by; null if nothing was late. A batch judges by the watermark at which the
    batch before it ran. Queries without state have no row."""
    judged = F.col("batch_id") + F.when(F.col("name") == WATERMARK, 1).otherwise(0)
    batches = (metrics.where(F.col("name").isin(LATE, WATERMARK)).groupBy("query", judged.alias("batch_id"))
               .agg(F.sum(F.when(F.col("name") == LATE, F.col("value"))).alias("late"),
                    F.max(F.when(F.col("name") == WATERMARK, F.col("value"))).alias("mark")))
    return (batches.where("late IS NOT NULL").groupBy("query")
            .agg(F.sum("late").cast("long").alias("late_rows"), F.count_if(F.col("late") > 0).alias("late_batches"),
                 F.max(F.when(F.col("late") > 0, F.col("mark"))).cast("long").alias("watermark_ms")))
