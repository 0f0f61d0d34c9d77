"""The three jobs and the enrichment, wired from ``JobConfig`` like the original entry points.

    python -m cartwheel.streaming.run revenue|kpi|alerts [--source-dir DIR] [--sink-dir DIR] [--bounded] [--metrics DIR] [--decoded-log DIR]
    python -m cartwheel.streaming.run enrich CSV_DIR OUT_DIR
    python -m cartwheel.streaming.run init-tables [--table-format parquet|iceberg] [--location DIR]

A job reads the orders topic (or, with ``--source-dir``, JSON order messages from files), and
writes its results to its topic (or, with ``--sink-dir``, Parquet files) and, when tables are
enabled, also appends them to its result table. A job is one streaming query, computed once for all its
outputs, with a fixed checkpoint ``<job>/main`` under ``spark.checkpoint.dir``, so a restart resumes. The
revenue job also runs the quarantine query for rejected events (K10). With ``--bounded`` the job reads
what is there, flushes what is still open (T8) and ends. Every progress report goes to the metrics table.

Master, partitions and resources come from the submit. ``--input-gb``, ``--executors`` and ``--cores`` may size the
partitions instead. When tables are enabled the result tables are in the catalog that the environment names.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cartwheel.config import TABLE_ALERTS, TABLE_KPIS, TABLE_REVENUE, JobConfig, result_database, table_catalog_settings
from cartwheel.session import build_session, checkpoint_root, cluster_settings
from cartwheel.operators.enrichment import time_order
from cartwheel.sinks.tables import create_result_tables
from cartwheel.sources.csv import enriched_events_from_csv
from cartwheel.sources.messages import decode_order_messages, encode_order_events
from cartwheel.streaming.bounded import with_end, write_end
from cartwheel.streaming.decoded import run_to_end, start_consumers, start_log
from cartwheel.streaming.jobs import Sink, alert_stream, kpi_stream, quarantine_stream, revenue_stream, start, start_all
from cartwheel.streaming.metrics import MetricsLog
from cartwheel.streaming.sources import order_stream_from_json_files, order_stream_from_kafka

JOBS = {
    "revenue": (revenue_stream, "revenue", lambda c: c.revenue_topic, TABLE_REVENUE),
    "kpi": (kpi_stream, "kpi", lambda c: c.kpi_topic, TABLE_KPIS),
    "alerts": (lambda ev, c: alert_stream(ev, c.suspicious_order_count, c.burst_span, c.price_anomaly_threshold,
                                          c.watermark_delay), "alert", lambda c: c.alerts_topic, TABLE_ALERTS),
}


def order_source(spark: SparkSession, config: JobConfig, source_dir: str | None = None) -> DataFrame:
    if source_dir:
        return order_stream_from_json_files(spark, source_dir)
    return order_stream_from_kafka(spark, config.bootstrap_servers, config.orders_topic,
                                   max_offsets_per_trigger=config.max_offsets_per_trigger)


def run_job(spark: SparkSession, job: str, config: JobConfig, source_dir: str | None = None,
            sink_dir: str | None = None, trigger: dict | None = None, end_dir: str | None = None,
            database: str | None = None) -> list[StreamingQuery]:
    """Start a job's queries. ``end_dir`` is where an end marker will be (see ``run_bounded``);
    ``database`` names the one of the result tables, if not that of the environment."""
    build, record, topic, table = JOBS[job]
    orders = order_source(spark, config, source_dir)
    events = with_end(orders, end_dir) if end_dir else orders
    if job == "alerts":
        result = build(events, config)
    else:
        result = build(events, config.window, config.watermark_delay)
    root = checkpoint_root(spark).rstrip("/") + f"/{job}"
    trig = trigger or {"processingTime": config.trigger_interval}
    if sink_dir:
        sinks = [Sink("parquet", f"{sink_dir.rstrip('/')}/{job}", f"{root}/main", trig)]
    else:
        sinks = [Sink("kafka", topic(config), f"{root}/main", trig, config.bootstrap_servers)]
    if config.table_enabled:
        sinks.append(Sink("table", f"{database or result_database()}.{table}", f"{root}/main", trig))
    queries = [start_all(result, record, sinks, f"{job}_main")]
    if job == "revenue":
        if sink_dir:
            rejected = Sink("parquet", f"{sink_dir.rstrip('/')}/quarantine", f"{root}/quarantine", trig)
        else:
            rejected = Sink("kafka", config.quarantine_topic, f"{root}/quarantine", trig, config.bootstrap_servers)
        queries.append(start(quarantine_stream(orders), "quarantine", rejected, "revenue_quarantine"))
    return queries


def run_bounded(spark: SparkSession, job: str, config: JobConfig, source_dir: str, sink_dir: str | None = None,
                database: str | None = None, log: MetricsLog | None = None) -> None:
    """Read all of ``source_dir``, then flush: the end marker comes after the last micro-batch of input, on the same checkpoint. With a
    ``log`` it is over when that has every report."""
    end = f"{checkpoint_root(spark).rstrip('/')}/{job}/end"
    for last in (False, True):
        if last:
            events = decode_order_messages(spark.read.text(source_dir))
            write_end(events, end, config.window, config.burst_span, config.watermark_delay)
        for q in run_job(spark, job, config, source_dir, sink_dir, {"availableNow": True}, end, database):
            q.awaitTermination()
            if log:
                log.wait_for(q)
            if q.exception():
                raise q.exception()


def run_alerts_from_log(spark: SparkSession, config: JobConfig, log_dir: str, source_dir: str | None = None, sink_dir: str | None = None,
                        bounded: bool = False, log: MetricsLog | None = None) -> list[StreamingQuery]:
    """The alert job with one decoded pass (``streaming.decoded``), and the quarantine as its third consumer. Returns the queries that run on."""
    root = checkpoint_root(spark).rstrip("/") + "/alerts_log"
    trig = {"availableNow": True} if bounded else {"processingTime": config.trigger_interval}

    def sink_of(name: str) -> Sink:
        if sink_dir:
            return Sink("parquet", f"{sink_dir.rstrip('/')}/{name}", f"{root}/{name}", trig)
        topic = config.quarantine_topic if name == "quarantine" else config.alerts_topic
        return Sink("kafka", topic, f"{root}/{name}", trig, config.bootstrap_servers)

    settings = {"min_count": config.suspicious_order_count, "span": config.burst_span, "threshold": config.price_anomaly_threshold,
                "delay": config.watermark_delay}
    orders = order_source(spark, config, source_dir)
    if bounded:
        run_to_end(spark, orders, log_dir, root, sink_of, log=log, **settings)
        return []
    return [start_log(orders, log_dir, f"{root}/decoded", trig), *start_consumers(spark, log_dir, sink_of, **settings).values()]


def write_replay_files(spark: SparkSession, csv_dir: str, out_dir: str, files: int | None = None) -> None:
    """The enrichment (S3-S5, J1, J2, P7, P8) sorted by purchase time (O1), written as JSON order
    messages: the file-based stand-in for the paced producer. Range partitioning gives each
    output file one contiguous time slice, so replaying files in name order keeps event time
    roughly ordered."""
    events = enriched_events_from_csv(spark, csv_dir, sort=False, positions=True)
    order = time_order(events)
    events = events.repartitionByRange(files, *order) if files else events.repartitionByRange(*order)
    ordered = events.sortWithinPartitions(*order)
    encode_order_events(ordered).select("value").write.mode("overwrite").text(out_dir)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cartwheel.streaming.run")
    ap.add_argument("job", choices=[*JOBS, "enrich", "init-tables"])
    ap.add_argument("paths", nargs="*")
    ap.add_argument("--source-dir")
    ap.add_argument("--sink-dir")
    ap.add_argument("--bounded", action="store_true")
    ap.add_argument("--decoded-log", help="folder of the decoded log: the alert job reads its source once (alerts and quarantine, no tables)")
    ap.add_argument("--metrics", help="folder of the metrics table (default: <sink-dir>/metrics, or none)")
    ap.add_argument("--master", help="default: as submitted")
    ap.add_argument("--input-gb", type=float)
    ap.add_argument("--executors", type=int, default=1)
    ap.add_argument("--cores", type=int, default=8)
    ap.add_argument("--table-format", default="parquet")
    ap.add_argument("--location")
    args = ap.parse_args(argv)
    config = JobConfig.from_env()
    extra = cluster_settings(int(args.input_gb * 2 ** 30), args.executors, args.cores) if args.input_gb else {}
    tables = config.table_enabled if args.job in JOBS else args.job == "init-tables" and args.table_format == "iceberg"
    if tables:
        extra |= table_catalog_settings()
    spark = build_session(args.master, extra=extra)
    if args.job == "enrich":
        write_replay_files(spark, args.paths[0], args.paths[1])
        return
    if args.job == "init-tables":
        for name in create_result_tables(spark, result_database(table_format=args.table_format), args.table_format, args.location):
            print(name)
        return
    metrics = args.metrics or (f"{args.sink_dir.rstrip('/')}/metrics" if args.sink_dir else None)
    log = MetricsLog(spark, metrics) if metrics else None
    if log:
        spark.streams.addListener(log)
    if args.decoded_log and args.job != "alerts":
        ap.error("--decoded-log is for the alert job")
    if args.decoded_log:
        queries = run_alerts_from_log(spark, config, args.decoded_log, args.source_dir, args.sink_dir, args.bounded, log)
        if queries:
            spark.streams.awaitAnyTermination()
        for q in queries:
            q.stop()
        return
    if args.bounded:
        run_bounded(spark, args.job, config, args.source_dir, args.sink_dir, log=log)
        return
    queries = run_job(spark, args.job, config, args.source_dir, args.sink_dir)
    spark.streams.awaitAnyTermination()
    for q in queries:
        q.stop()


if __name__ == "__main__":
    main()
