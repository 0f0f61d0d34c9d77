"""The alert job with one decoded pass for several consumers.

One query reads and decodes the source and writes every order event to a log, a folder of Parquet files with the file sink's own
record of complete batches, so that a batch that runs again is in the log once. Bursts, price alerts and the quarantine of rejected events
read the log, each with a checkpoint of its own: a consumer may stop, fall behind or be added later without the source being read again,
and price alerts are not held to the watermark of the bursts. The log is the job's copy of its input; what all consumers have read may go by age.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cartwheel.config import (DEFAULT_BURST_SPAN, DEFAULT_PRICE_ANOMALY_THRESHOLD, DEFAULT_SUSPICIOUS_ORDER_COUNT,
                              DEFAULT_WATERMARK_DELAY)
from cartwheel.operators.alerts import price_anomaly_alerts
from cartwheel.schemas import ORDER_EVENT
from cartwheel.session import make_folder
from cartwheel.streaming.bounded import with_end, write_end
from cartwheel.streaming.bursts import suspicious_frequency_stream
from cartwheel.streaming.jobs import Sink, quarantine_stream, start
from cartwheel.streaming.metrics import MetricsLog, observe_alerts
from cartwheel.streaming.sources import with_event_time

RECORDS = {"bursts": "alert", "prices": "alert", "quarantine": "quarantine"}     # what each consumer gives


def start_log(orders: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None, name: str = "decoded") -> StreamingQuery:
    """Write the order events of a stream to the log in ``folder``."""
    w = (orders.select(ORDER_EVENT.names).writeStream.queryName(name).format("parquet").outputMode("append")
         .option("path", folder).option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events of a log as a stream; the log may be empty as yet."""
    make_folder(spark, folder)
    return spark.readStream.schema(ORDER_EVENT).parquet(folder)


def consumer(name: str, events: DataFrame, min_count: int = DEFAULT_SUSPICIOUS_ORDER_COUNT, span: str = DEFAULT_BURST_SPAN,
             threshold=DEFAULT_PRICE_ANOMALY_THRESHOLD, delay: str = DEFAULT_WATERMARK_DELAY) -> DataFrame:
    """The rows of one of ``RECORDS`` from the events of a log."""
    if name == "bursts":
        return observe_alerts(suspicious_frequency_stream(with_event_time(events, delay), min_count, span))
    if name == "prices":
        return observe_alerts(price_anomaly_alerts(events, threshold))
    if name == "quarantine":
        return quarantine_stream(events)
    raise ValueError(f"no consumer {name!r}; there are {', '.join(RECORDS)}")


def start_consumers(spark: SparkSession, folder: str, sink_of: Callable[[str], Sink], prefix: str = "alerts", end: str | None = None,
                    **settings) -> dict[str, StreamingQuery]:
    """Start every consumer of the log in ``folder``; ``sink_of`` names the sink of each, with its checkpoint. ``end`` is the
    folder of an end marker, for a bounded input."""
    events = read_log(spark, folder)
    # only the bursts wait for a watermark
    return {name: start(consumer(name, with_end(events, end) if end and name == "bursts" else events, **settings),
                        record, sink_of(name), f"{prefix}_{name}") for name, record in RECORDS.items()}


def run_to_end(spark: SparkSession, orders: DataFrame, folder: str, checkpoint: str, sink_of: Callable[[str], Sink], prefix: str = "alerts",
               log: MetricsLog | None = None, **settings) -> None:
    """A bounded run: the source into the log, then all consumers to the end of the log, where an end marker judges what is
    open. Triggers are those of the sinks (``availableNow``). Run again, it goes on with what has come since."""
    def ended(query: StreamingQuery) -> None:
        query.awaitTermination()
        if log:
            log.wait_for(query)
        if query.exception():
            raise query.exception()

    ended(start_log(orders, folder, f"{checkpoint.rstrip('/')}/decoded", {"availableNow": True}, f"{prefix}_decoded"))
    end = f"{checkpoint.rstrip('/')}/end"
    write_end(spark.read.schema(ORDER_EVENT).parquet(folder), end, settings.get("span", DEFAULT_BURST_SPAN),
              settings.get("delay", DEFAULT_WATERMARK_DELAY))
    for query in start_consumers(spark, folder, sink_of, prefix, end, **settings).values():
        ended(query)
