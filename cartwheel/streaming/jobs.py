"""The three jobs as Structured Streaming queries, plus the quarantine query.

Each job is the batch operator applied to a watermarked stream, written in append mode: a
window is emitted once, when the watermark passes its end (T3/T4); rows behind the watermark
are dropped by the window state. Exactly-once state comes from the checkpoint location (one
fixed folder per query, which also keeps state across restarts, T5/T7); file and table sinks are
exactly-once (``cartwheel.sinks.commits``), Kafka at-least-once.

Sinks: ``parquet`` (path), ``table``, ``kafka`` (JSON messages, K1-K3), ``memory``.
A result with several sinks is one query (``start_all``): it is computed once per micro-batch and
written to each. Files and tables have one layout however many sinks there are, so their number may change between runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha1

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.config import (DEFAULT_BURST_SPAN, DEFAULT_PRICE_ANOMALY_THRESHOLD, DEFAULT_SUSPICIOUS_ORDER_COUNT,
                              DEFAULT_WATERMARK_DELAY, DEFAULT_WINDOW)
from cartwheel.operators.alerts import price_anomaly_alerts, union_alerts
from cartwheel.operators.kpis import realtime_kpis
from cartwheel.operators.revenue import revenue_by_category
from cartwheel.operators.validation import is_valid
from cartwheel.schemas import EVENT_TIME
from cartwheel.session import exists, make_folder
from cartwheel.sinks.commits import append_once, is_plain_table, write_committed
from cartwheel.sinks.json_encode import alert_json, kpi_json, revenue_json
from cartwheel.sinks.tables import has_partition_column, to_alert_rows, to_kpi_rows, to_revenue_rows
from cartwheel.sources.messages import encode_order_events
from cartwheel.streaming.bursts import suspicious_frequency_stream
from cartwheel.streaming.metrics import observe_alerts, observe_kpis, observe_revenue
from cartwheel.streaming.sources import with_event_time


def revenue_stream(events: DataFrame, window: str = DEFAULT_WINDOW, delay: str = DEFAULT_WATERMARK_DELAY) -> DataFrame:
    return observe_revenue(revenue_by_category(with_event_time(events, delay), window))


def kpi_stream(events: DataFrame, window: str = DEFAULT_WINDOW, delay: str = DEFAULT_WATERMARK_DELAY) -> DataFrame:
    return observe_kpis(realtime_kpis(with_event_time(events, delay), window))


def alert_stream(events: DataFrame, min_count: int = DEFAULT_SUSPICIOUS_ORDER_COUNT, span: str = DEFAULT_BURST_SPAN,
                 threshold=DEFAULT_PRICE_ANOMALY_THRESHOLD, delay: str = DEFAULT_WATERMARK_DELAY) -> DataFrame:
    """Burst alerts (stateful, event time from the watermark, late events dropped) union price
    alerts (stateless, read from the stream without a watermark, so late events are kept and
    their filter cannot hold event time back)."""
    bursts = suspicious_frequency_stream(with_event_time(events, delay), min_count, span)
    return observe_alerts(union_alerts(bursts, price_anomaly_alerts(events, threshold)))


def quarantine_stream(events: DataFrame) -> DataFrame:
    """Events the revenue job rejects (no category or no price), and events without a
    purchase time (no window can take them; the original job fails on them)."""
    no_cat, no_price = F.col("product_category").isNull(), F.col("price").isNull()
    no_time = F.col(EVENT_TIME).isNull()
    reason = (F.when(no_time, F.lit("no purchase time"))
               .when(no_cat & no_price, F.lit("no category, no price"))
               .when(no_cat, F.lit("no category")).otherwise(F.lit("no price")))
    return events.where(~is_valid() | no_time).withColumn("quarantined_reason", reason)


def quarantine_json(events: DataFrame) -> DataFrame:
    return encode_order_events(events, more=["quarantined_reason"])


TABLE_ROWS = {"kpi": to_kpi_rows, "alert": to_alert_rows}
JSON_ROWS = {"revenue": revenue_json, "kpi": kpi_json, "alert": alert_json, "quarantine": quarantine_json}


def rows_for(result: DataFrame, record: str, sink: "Sink") -> DataFrame:
    """The result in the columns of its sink."""
    if sink.kind == "kafka":
        return JSON_ROWS[record](result)
    if sink.kind == "table" and record == "revenue":
        return to_revenue_rows(result, has_partition_column(result.sparkSession, sink.target))
    if sink.kind == "table" and record in TABLE_ROWS:
        return TABLE_ROWS[record](result)
    return result


@dataclass
class Sink:
    kind: str                       # parquet | table | kafka | memory
    target: str                     # path, table name, topic or memory name
    checkpoint: str
    trigger: dict | None = None     # e.g. {"availableNow": True} or {"processingTime": "30 seconds"}
    bootstrap_servers: str | None = None


def start(result: DataFrame, record: str, sink: Sink, name: str) -> StreamingQuery:
    """Start an append-mode query for ``result`` (record: revenue | kpi | alert | quarantine)."""
    if sink.kind in ("parquet", "table"):
        return _start_batches(result, record, [sink], name)
    w = (rows_for(result, record, sink).writeStream.queryName(name).outputMode("append")
         .option("checkpointLocation", sink.checkpoint))
    if sink.trigger:
        w = w.trigger(**sink.trigger)
    if sink.kind == "kafka":
        return (w.format("kafka").option("kafka.bootstrap.servers", sink.bootstrap_servers)
                .option("topic", sink.target).start())
    if sink.kind == "memory":
        return w.format("memory").start()
    raise ValueError(f"unknown sink kind {sink.kind!r}")


def write_batch(rows: DataFrame, record: str, sink: Sink, batch_id: int) -> None:
    """One micro-batch to one sink. A batch that runs again after a failure replaces its own files, and is in a plain
    Parquet table once. To a table of another format it is appended if its mark, written afterwards, is missing; a topic may get it twice."""
    out = rows_for(rows, record, sink)
    if sink.kind == "parquet":
        write_committed(out, sink.target, batch_id)
    elif sink.kind == "table" and is_plain_table(rows.sparkSession, sink.target):
        query = sha1(sink.checkpoint.encode()).hexdigest()[:12]
        append_once(out, sink.target, f"{sink.checkpoint.rstrip('/')}/staged/{batch_id}", f"{query}-{batch_id}")
    elif sink.kind == "table":
        mark = f"{sink.checkpoint.rstrip('/')}/written/{batch_id}"
        if not exists(rows.sparkSession, mark):
            out.write.insertInto(sink.target)
            make_folder(rows.sparkSession, mark)
    elif sink.kind == "kafka":
        (out.write.format("kafka").option("kafka.bootstrap.servers", sink.bootstrap_servers)
         .option("topic", sink.target).save())
    else:
        raise ValueError(f"sink kind {sink.kind!r} cannot be one of several")


def start_all(result: DataFrame, record: str, sinks: list[Sink], name: str) -> StreamingQuery:
    """One query for all sinks of a result, with the checkpoint and trigger of the first."""
    if len(sinks) == 1:
        return start(result, record, sinks[0], name)
    return _start_batches(result, record, sinks, name)


def _start_batches(result: DataFrame, record: str, sinks: list[Sink], name: str) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) == 1:
            write_batch(batch, record, sinks[0], batch_id)
            return
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            for sink in sinks:
                write_batch(batch, record, sink, batch_id)
        finally:
            batch.unpersist()

    w = (result.writeStream.queryName(name).outputMode("append").option("checkpointLocation", sinks[0].checkpoint)
         .foreachBatch(write))
    return (w.trigger(**sinks[0].trigger) if sinks[0].trigger else w).start()
