"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each query is a feed (``cartwheel.sources.feeds``) followed by library operators; the result is
passed through ``for_oracle`` so that it compares one-to-one with its DuckDB formulation
(``cartwheel.plans.oracle``): decimals as double, timestamps without zone (UTC wall clock).
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.columns import event_value
from cartwheel.operators.alerts import price_anomaly_alerts, union_alerts
from cartwheel.operators.bursts import suspicious_frequency_alerts
from cartwheel.operators.kpis import realtime_kpis
from cartwheel.operators.revenue import revenue_by_category
from cartwheel.operators.validation import invalid_events, valid_events
from cartwheel.plans import oracle
from cartwheel.sources.feeds import FEEDS, event_feed, item_feed

Query = Callable[[SparkSession, str], DataFrame]


def for_oracle(df: DataFrame) -> DataFrame:
    """decimal -> double, timestamp -> timestamp_ntz; names unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return for_oracle(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


# --- feeds and filters (J1, J2, P1, P2, P3) -------------------------------------------------

@register("order_events_enriched", oracle.feed_rows("item"))
def _order_events_enriched(spark, sf):
    """orders LEFT items LEFT products, one event per item."""
    return item_feed(spark, sf)


@register("order_event_feed", oracle.feed_rows("event"))
def _order_event_feed(spark, sf):
    """The events table mapped to order events."""
    return event_feed(spark, sf)


for _feed in ("event", "item"):
    def _values(spark, sf, _f=_feed):
        """value = price + freight, a missing part as 0."""
        return FEEDS[_f](spark, sf).withColumn("value", event_value())

    register(f"order_event_values_{_feed}",
             oracle.feed_rows(_feed, extra=", CAST(coalesce(price, 0) + coalesce(freight_value, 0) AS DOUBLE) AS value"))(_values)

    def _valid(spark, sf, _f=_feed):
        """Category and price present."""
        return valid_events(FEEDS[_f](spark, sf))

    register(f"valid_order_events_{_feed}",
             oracle.feed_rows(_feed, "product_category IS NOT NULL AND price IS NOT NULL"))(_valid)

    def _invalid(spark, sf, _f=_feed):
        """P3 complement: the side output."""
        return invalid_events(FEEDS[_f](spark, sf))

    register(f"invalid_order_events_{_feed}",
             oracle.feed_rows(_feed, "product_category IS NULL OR price IS NULL"))(_invalid)


# --- windows and aggregates (A1-A5, W1, W2) ---------------------------------------------------

@register("revenue_by_category_1m", oracle.revenue("event", "minute"))
def revenue_by_category_1m(spark, sf):
    """Flagship: revenue per category and 1-minute window over the event feed."""
    return revenue_by_category(event_feed(spark, sf), "1 minute")


@register("revenue_by_category_daily_items", oracle.revenue("item", "day"))
def _revenue_daily_items(spark, sf):
    return revenue_by_category(item_feed(spark, sf), "1 day")


@register("realtime_kpis_1m", oracle.kpis("event", "minute", 1.0))
def _kpis_1m(spark, sf):
    return realtime_kpis(event_feed(spark, sf), "1 minute")


@register("realtime_kpis_daily_items", oracle.kpis("item", "day", 1440.0))
def _kpis_daily_items(spark, sf):
    return realtime_kpis(item_feed(spark, sf), "1 day")


# --- alerts (P5, P6, W3, U1) ------------------------------------------------------------------

@register("price_anomaly_alerts_event_400", oracle.with_feed("event", oracle.price_alerts_body("400")))
def _price_event(spark, sf):
    return price_anomaly_alerts(event_feed(spark, sf), "400")


@register("price_anomaly_alerts_items_500", oracle.with_feed("item", oracle.price_alerts_body("500")))
def _price_items_500(spark, sf):
    return price_anomaly_alerts(item_feed(spark, sf), "500")


@register("price_anomaly_alerts_items_90000", oracle.with_feed("item", oracle.price_alerts_body("90000")))
def _price_items_90000(spark, sf):
    return price_anomaly_alerts(item_feed(spark, sf), "90000")


@register("suspicious_frequency_alerts_5m_items",
          oracle.burst_alerts("item", 3, "5 MINUTE", "5 minutes"))
def _bursts_items(spark, sf):
    return suspicious_frequency_alerts(item_feed(spark, sf), 3, "5 minutes")


@register("suspicious_frequency_alerts_5m_event",
          oracle.burst_alerts("event", 3, "5 MINUTE", "5 minutes"))
def _bursts_event_5m(spark, sf):
    return suspicious_frequency_alerts(event_feed(spark, sf), 3, "5 minutes")


@register("suspicious_frequency_alerts_1d_event",
          oracle.burst_alerts("event", 3, "1 DAY", "1440 minutes"))
def _bursts_event_1d(spark, sf):
    return suspicious_frequency_alerts(event_feed(spark, sf), 3, "1 day")


@register("all_alerts_event",
          oracle.with_feed("event", "").rstrip()
          + oracle.burst_alerts_body(3, "1 DAY", "1440 minutes")
          + "\nUNION ALL" + oracle.price_alerts_body("400"))
def _all_alerts_event(spark, sf):
    """Burst alerts (1-day span) and price alerts of the event feed in one stream."""
    feed = event_feed(spark, sf)
    return union_alerts(suspicious_frequency_alerts(feed, 3, "1 day"), price_anomaly_alerts(feed, "400"))


@register("all_alerts_items",
          oracle.with_feed("item", "").rstrip()
          + oracle.burst_alerts_body(3, "5 MINUTE", "5 minutes")
          + "\nUNION ALL" + oracle.price_alerts_body("90000"))
def _all_alerts_items(spark, sf):
    feed = item_feed(spark, sf)
    return union_alerts(suspicious_frequency_alerts(feed, 3, "5 minutes"), price_anomaly_alerts(feed, "90000"))


# --- JSON in and out (S2, K4) -------------------------------------------------------------------

def order_messages(spark, sf):
    """The event feed as producer JSON messages; messages of 'error' events carry an unparsable
    purchase time (a bad field fails the whole message)."""
    from cartwheel.functions.columns import PURCHASE_TS_FORMAT
    from cartwheel.sources.messages import encode_order_events
    feed = event_feed(spark, sf)
    time_text = (F.when(F.col("product_category").isNull(), F.lit("not a time"))
                  .otherwise(F.date_format("order_purchase_timestamp", PURCHASE_TS_FORMAT)))
    return encode_order_events(feed, time_text)


@register("decode_order_json", oracle.decoded_events("event"))
def _decode_order_json(spark, sf):
    """Decoded valid messages."""
    from cartwheel.sources.messages import decode_order_messages
    return decode_order_messages(order_messages(spark, sf))


@register("decode_order_json_outcomes", oracle.decode_outcomes("event"))
def _decode_outcomes(spark, sf):
    """Messages kept and dropped, by outcome."""
    from cartwheel.sources.messages import decode_outcomes
    return decode_outcomes(order_messages(spark, sf))


@register("revenue_json", oracle.revenue_json("event"))
def _revenue_json(spark, sf):
    from cartwheel.sinks.json_encode import revenue_json
    return revenue_json(revenue_by_category(event_feed(spark, sf)))


@register("kpi_json", oracle.kpi_json("event"))
def _kpi_json(spark, sf):
    from cartwheel.sinks.json_encode import kpi_json
    return kpi_json(realtime_kpis(event_feed(spark, sf)))


@register("price_alert_json_items", oracle.price_alert_json("item", "90000"))
def _price_alert_json(spark, sf):
    from cartwheel.sinks.json_encode import alert_json
    return alert_json(price_anomaly_alerts(item_feed(spark, sf), "90000"))


@register("all_alerts_json_event", oracle.all_alerts_json("event", 3, "1 DAY", "1440 minutes", "400"))
def _all_alerts_json_event(spark, sf):
    """K4 for both alert kinds: burst alerts carry a JSON null value."""
    from cartwheel.sinks.json_encode import alert_json
    feed = event_feed(spark, sf)
    return alert_json(union_alerts(suspicious_frequency_alerts(feed, 3, "1 day"), price_anomaly_alerts(feed, "400")))


# --- tables (K5-K9) and CSV sources (S3-S5, P7, P8, O1) -------------------------------------------

@register("revenue_table_rows", oracle.with_text(oracle.revenue_table_rows("event"), "total_revenue"))
def _revenue_table_rows(spark, sf):
    """K9: revenue rows coerced to the table schema, with the partition date (and one amount as text, scale and all)."""
    from cartwheel.sinks.tables import to_revenue_rows
    rows = to_revenue_rows(revenue_by_category(event_feed(spark, sf)))
    return rows.withColumn("total_revenue_text", F.col("total_revenue").cast("string"))


def _table_roundtrip(spark, append, result, table: int) -> DataFrame:
    """Create the result tables in the checkpoint folder, append, read back through the catalog; the tables go again."""
    from cartwheel.session import scratch_path
    from cartwheel.sinks.tables import create_result_tables
    location = scratch_path(spark, "tables")
    db = "run_" + location.rsplit("-", 1)[1]
    names = create_result_tables(spark, db, "parquet", location)
    append(result, names[table])
    back = scratch_path(spark, "table-rows")
    spark.table(names[table]).write.parquet(back)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.read.parquet(back)


@register("revenue_table_roundtrip", oracle.revenue_table_rows("event", "minute"))
def _revenue_table_roundtrip(spark, sf):
    """K5/K8: the 1-minute revenue in its table (partitioned by day)."""
    from cartwheel.sinks.tables import append_revenue
    return _table_roundtrip(spark, append_revenue, revenue_by_category(event_feed(spark, sf)), 0)


@register("kpi_table_roundtrip", oracle.with_text(oracle.kpis("event", "minute", 1.0), "average_order_value"))
def _kpi_table_roundtrip(spark, sf):
    """K6: the 1-minute KPIs in their table."""
    from cartwheel.sinks.tables import append_kpis
    rows = _table_roundtrip(spark, append_kpis, realtime_kpis(event_feed(spark, sf)), 1)
    return rows.withColumn("average_order_value_text", F.col("average_order_value").cast("string"))


@register("alert_table_roundtrip", oracle.with_text(oracle.with_feed("item", oracle.price_alerts_body("90000")), "value"))
def _alert_table_roundtrip(spark, sf):
    """K7: price alerts in their table."""
    from cartwheel.sinks.tables import append_alerts
    rows = _table_roundtrip(spark, append_alerts, price_anomaly_alerts(item_feed(spark, sf), "90000"), 2)
    return rows.withColumn("value_text", F.col("value").cast("string"))


@register("price_alerts_from_wide_json", oracle.wide_price_alerts("event"))
def _price_alerts_from_wide_json(spark, sf):
    """Amounts with more digits than money has, from JSON messages. Every third message has 4 thousandths
    added to the price, every fifth 12,345,678,900; a message whose order id is an object is dropped, an empty
    freight is null."""
    from cartwheel.sources.messages import decode_order_messages, encode_order_events
    feed = event_feed(spark, sf)
    n = F.col("order_id").cast("long")
    extra = F.when(n % 3 == 0, F.lit(Decimal("0.004"))).otherwise(F.lit(Decimal("0"))) + \
        F.when(n % 5 == 0, F.lit(Decimal("12345678900"))).otherwise(F.lit(Decimal("0")))
    messages = encode_order_events(feed.withColumn("price", (F.col("price") + extra).cast("decimal(27,6)")))
    value = F.when(n % 7 == 0, F.regexp_replace("value", '"order_id":"[^"]*"', '"order_id":{}')).otherwise(
        F.regexp_replace("value", '"freight_value":[^,]*', '"freight_value":""'))
    decoded = decode_order_messages(messages.select(F.col("key").alias("order_id"), "value").select(value.alias("value")))
    alerts = price_anomaly_alerts(decoded, "400")
    return alerts.withColumn("value_text", F.col("value").cast("string"))


@register("order_events_by_time", oracle.positions("item"))
def _order_events_by_time(spark, sf):
    """O1: every order event with its position in the order by purchase time."""
    from cartwheel.operators.enrichment import with_position
    from cartwheel.session import scratch_path
    return with_position(item_feed(spark, sf), scratch_path(spark, "by-time"))


@register("order_events_from_csv", oracle.csv_rows("item"))
def _order_events_from_csv(spark, sf):
    """The driver tables written as three CSV files, then enriched from CSV (sorted). The files
    have quoted values with commas, quotes and line breaks, two column orders, unparsable times (every 11th order, which
    is skipped) and amounts (every 13th part: the price becomes 0)."""
    from cartwheel.session import scratch_path
    from cartwheel.sources.csv import enriched_events_from_csv
    from cartwheel.sources.tables import read_table
    d = scratch_path(spark, "csv")
    orders = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("not, a time")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("order_purchase_timestamp"),
        F.concat(F.lit('said "'), "o_orderpriority", F.lit('",\nand left')).alias("note"))
    items = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"), F.col("l_suppkey").cast("string").alias("seller_id"),
        F.when(F.col("l_partkey") % 13 == 0, F.lit("1,2 \"?")).otherwise(
            F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("price"),
        F.col("l_quantity").cast("decimal(12,2)").cast("string").alias("freight_value"))
    products = read_table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.col("p_type"), F.lit(', "new"\nline')).alias("product_category_name"), F.col("p_size").alias("product_weight_g"))
    for df, name in [(orders, "olist_orders_dataset.csv"), (items, "olist_order_items_dataset.csv"),
                     (products, "olist_products_dataset.csv")]:
        for k, columns in enumerate((df.columns, df.columns[::-1])):     # half the rows in another column order
            half = df.where(F.pmod(F.xxhash64(df.columns[0]), F.lit(2)) == k).select(columns)
            half.write.mode("append").option("header", "true").option("escape", '"').csv(f"{d}/{name}")
    return enriched_events_from_csv(spark, d, sort=True)


# --- streams (T1, T3, T4, T5, W3 stream, K10, M1-M7) ----------------------------------------------

def _run_to_end(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _replay(spark: SparkSession, sf: str, build, record: str, name: str, spans: tuple[str, ...] = (),
            log=None, json_dir: str | None = None) -> DataFrame:
    """Replay the events table (or JSON order messages in ``json_dir``) as a stream through ``build`` into a
    Parquet sink (availableNow), then read the sink back. With ``spans`` the input is ended, so nothing stays open: it
    is one micro-batch, and the end marker may come with it."""
    from cartwheel.session import scratch_path
    from cartwheel.sinks.commits import read_committed
    from cartwheel.sources.messages import decode_order_messages
    from cartwheel.streaming.bounded import with_end, write_end
    from cartwheel.streaming.jobs import Sink, start
    from cartwheel.streaming.sources import order_stream_from_files, order_stream_from_json_files
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    source = order_stream_from_json_files(spark, json_dir) if json_dir else order_stream_from_files(spark, f"{sf}/events.parquet")
    if spans:
        end = scratch_path(spark, f"{name}-end")
        write_end(decode_order_messages(spark.read.text(json_dir)) if json_dir else event_feed(spark, sf), end, *spans)
        source = with_end(source, end)
    result = build(source)
    q = start(result, record, Sink("parquet", out, ckpt, {"availableNow": True}), f"{name}_{out[-12:]}")
    _run_to_end(q)
    if log is not None:
        log.wait_for(q)
        log.rows[name] = [(name, *r[1:]) for r in log.rows.pop(q.name, [])]
    return read_committed(spark, out, result.schema)


def _replay_in_parts(spark: SparkSession, sf: str, build, record: str, name: str, parts: list, spans: tuple[str, ...],
                     log=None) -> DataFrame:
    """Replay the events in parts (conditions on the events table). Each part arrives in the source folder after the query
    has stopped, and the query goes on from its checkpoint; the end comes last."""
    from cartwheel.session import scratch_path
    from cartwheel.sinks.commits import read_committed
    from cartwheel.sources.tables import read_table
    from cartwheel.streaming.bounded import with_end, write_end
    from cartwheel.streaming.jobs import Sink, start
    from cartwheel.streaming.sources import order_stream_from_files
    folder, end, out, ckpt = (scratch_path(spark, f"{name}-{k}") for k in ("in", "end", "out", "ckpt"))
    for part in [*parts, None]:
        if part is None:
            write_end(event_feed(spark, sf), end, *spans)
        else:
            read_table(spark, sf, "events").where(part).write.mode("append").parquet(folder)
        result = build(with_end(order_stream_from_files(spark, folder), end))
        q = start(result, record, Sink("parquet", out, ckpt, {"availableNow": True}), f"{name}_{out[-12:]}")
        _run_to_end(q)
        if log is not None:
            log.wait_for(q)
            log.rows.setdefault(name, []).extend((name, *r[1:]) for r in log.rows.pop(q.name, []))
    return read_committed(spark, out, result.schema)


MINUTE_SPANS = ("1 minute", "10 seconds")
DAY_SPANS = ("1 day", "10 seconds")


@register("revenue_stream_replay", oracle.revenue("event", "minute"))
def _revenue_stream_replay(spark, sf):
    from cartwheel.streaming.jobs import revenue_stream
    return _replay(spark, sf, revenue_stream, "revenue", "revenue_replay", MINUTE_SPANS)


@register("kpi_stream_replay", oracle.kpis("event", "minute", 1.0))
def _kpi_stream_replay(spark, sf):
    from cartwheel.streaming.jobs import kpi_stream
    return _replay(spark, sf, kpi_stream, "kpi", "kpi_replay", MINUTE_SPANS)


@register("alerts_stream_replay", ORACLE["all_alerts_event"])
def _alerts_stream_replay(spark, sf):
    """W3 as a stateful stream (1-day span) united with price alerts (threshold 400)."""
    from cartwheel.streaming.jobs import alert_stream
    return _replay(spark, sf, lambda s: alert_stream(s, 3, "1 day", "400"), "alert", "alerts_replay", DAY_SPANS)


@register("revenue_stream_late_part", oracle.late_revenue("event"))
def _revenue_stream_late_part(spark, sf):
    """Events with an odd id arrive when the watermark has passed almost all of their windows."""
    from cartwheel.streaming.jobs import revenue_stream
    return _replay_in_parts(spark, sf, revenue_stream, "revenue", "revenue_late", ["event_id % 2 = 0", "event_id % 2 = 1"], MINUTE_SPANS)


@register("stream_lateness", oracle.lateness("event"))
def _stream_lateness(spark, sf):
    """The late groups that the revenue and KPI jobs dropped when events with an odd id came after all others, and the watermark then."""
    from cartwheel.streaming.jobs import kpi_stream, revenue_stream
    from cartwheel.streaming.metrics import MetricsLog, lateness, metrics_frame
    log = MetricsLog(spark)
    spark.streams.addListener(log)
    try:
        for name, build in (("revenue", revenue_stream), ("kpi", kpi_stream)):
            _replay_in_parts(spark, sf, build, name, name, ["event_id % 2 = 0", "event_id % 2 = 1"], MINUTE_SPANS, log)
    finally:
        spark.streams.removeListener(log)
    return lateness(metrics_frame(spark, log.rows.get("revenue", []) + log.rows.get("kpi", [])))


@register("kpi_stream_restart", oracle.kpis("event", "minute", 1.0))
def _kpi_stream_restart(spark, sf):
    """T5: the query stops in the middle of the events and goes on from its checkpoint."""
    from cartwheel.sources.tables import read_table
    from cartwheel.streaming.jobs import kpi_stream
    first, last = read_table(spark, sf, "events").agg(F.unix_micros(F.min("ts").cast("timestamp")), F.unix_micros(F.max("ts").cast("timestamp"))).first()
    if first is None:
        return realtime_kpis(event_feed(spark, sf))
    middle = F.timestamp_micros(F.lit((first + last) // 2))
    early = F.col("ts").cast("timestamp") < middle
    return _replay_in_parts(spark, sf, kpi_stream, "kpi", "kpi_restart", [early, ~early], MINUTE_SPANS)


def _from_log(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    """The events through one decoded log; rows of the named consumers."""
    from cartwheel.session import scratch_path
    from cartwheel.sinks.commits import read_committed
    from cartwheel.streaming.decoded import consumer, read_log, run_to_end
    from cartwheel.streaming.jobs import Sink
    from cartwheel.streaming.sources import order_stream_from_files
    settings = {"min_count": 3, "span": "1 day", "threshold": "400"}
    folder, out, ckpt = (scratch_path(spark, f"decoded-{k}") for k in ("log", "out", "ckpt"))
    run_to_end(spark, order_stream_from_files(spark, f"{sf}/events.parquet"), folder, ckpt,
               lambda name: Sink("parquet", f"{out}/{name}", f"{ckpt}/{name}", {"availableNow": True}), f"log_{out[-12:]}", **settings)
    return [read_committed(spark, f"{out}/{name}", consumer(name, read_log(spark, folder), **settings).schema) for name in names]


@register("alerts_from_decoded_log", ORACLE["all_alerts_event"])
def _alerts_from_decoded_log(spark, sf):
    """Bursts (1-day span) and price alerts (threshold 400) as two consumers of one decoded log."""
    bursts, prices = _from_log(spark, sf, "bursts", "prices")
    return bursts.unionByName(prices)


@register("quarantine_from_decoded_log", oracle.quarantine_rows("event"))
def _quarantine_from_decoded_log(spark, sf):
    """K10 as a consumer of the decoded log."""
    return _from_log(spark, sf, "quarantine")[0]


@register("bursts_stream_processor", oracle.burst_alerts("event", 3, "1 DAY", "1440 minutes"))
def _bursts_stream_processor(spark, sf):
    """W3 by a state processor with one event-time timer a key (1-day span)."""
    from cartwheel.session import STATE_DEFAULTS, settings
    from cartwheel.streaming.bursts import suspicious_frequency_processor
    from cartwheel.streaming.sources import with_event_time
    with settings(spark, STATE_DEFAULTS):       # the given session may have Spark's own store, which can't hold a processor's state
        return _replay(spark, sf, lambda s: suspicious_frequency_processor(with_event_time(s), 3, "1 day"), "alert", "bursts_processor", DAY_SPANS)


@register("bursts_stream_restored", oracle.burst_alerts("event", 3, "1 DAY", "1440 minutes"))
def _bursts_stream_restored(spark, sf):
    """The burst query stops in the middle of the events; a new one with more state partitions goes on from its state."""
    from cartwheel.session import STATE_DEFAULTS, scratch_path, settings
    from cartwheel.sinks.commits import read_committed
    from cartwheel.sources.tables import read_table
    from cartwheel.streaming.bounded import with_end, write_end
    from cartwheel.streaming.bursts import suspicious_frequency_processor
    from cartwheel.streaming.jobs import Sink, start
    from cartwheel.streaming.sources import order_stream_from_files, with_event_time
    early, late, end = (scratch_path(spark, f"bursts_restored-{k}") for k in ("early", "late", "end"))
    events = read_table(spark, sf, "events")
    first, last = events.agg(F.unix_micros(F.min("ts").cast("timestamp")), F.unix_micros(F.max("ts").cast("timestamp"))).first()
    if first is None:
        return suspicious_frequency_alerts(event_feed(spark, sf), 3, "1 day")
    is_early = F.col("ts").cast("timestamp") < F.timestamp_micros(F.lit((first + last) // 2))
    events.where(is_early).write.parquet(early)
    events.where(~F.coalesce(is_early, F.lit(False))).write.parquet(late)
    write_end(event_feed(spark, sf), end, *DAY_SPANS)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out, before = [], None
    for n, orders in ((partitions, order_stream_from_files(spark, early)), (partitions + 3, with_end(order_stream_from_files(spark, late), end))):
        with settings(spark, {**STATE_DEFAULTS, "spark.sql.shuffle.partitions": str(n)}):
            result = suspicious_frequency_processor(with_event_time(orders), 3, "1 day", restore=before)
            to, before = scratch_path(spark, "bursts_restored-out"), scratch_path(spark, "bursts_restored-ckpt")
            _run_to_end(start(result, "alert", Sink("parquet", to, before, {"availableNow": True}), f"bursts_{to[-12:]}"))
            out.append(read_committed(spark, to, result.schema))
    return out[0].unionByName(out[1])


@register("quarantine_stream_replay", oracle.quarantine_rows("event"))
def _quarantine_stream_replay(spark, sf):
    from cartwheel.streaming.jobs import quarantine_stream
    return _replay(spark, sf, quarantine_stream, "quarantine", "quarantine_replay")


def _metric_replays(spark, sf, jobs: tuple[str, ...] = ("revenue", "kpi", "alerts")) -> DataFrame:
    """Revenue and KPI replays of the events table, and an alert replay from JSON messages
    (with bad messages, so the decoder counts errors); their progress reports as metric rows."""
    from cartwheel.session import scratch_path
    from cartwheel.streaming.jobs import alert_stream, kpi_stream, revenue_stream
    from cartwheel.streaming.metrics import MetricsLog, metrics_frame
    log = MetricsLog(spark)
    spark.streams.addListener(log)
    try:
        if "revenue" in jobs:
            _replay(spark, sf, revenue_stream, "revenue", "revenue", MINUTE_SPANS, log)
        if "kpi" in jobs:
            _replay(spark, sf, kpi_stream, "kpi", "kpi", MINUTE_SPANS, log)
        if "alerts" in jobs:
            msgs = scratch_path(spark, "messages")
            order_messages(spark, sf).select("value").write.text(msgs)
            _replay(spark, sf, lambda s: alert_stream(s, 3, "1 day", "400"), "alert", "alerts", DAY_SPANS, log, msgs)
    finally:
        spark.streams.removeListener(log)
    return metrics_frame(spark, [r for j in jobs for r in log.rows.get(j, [])])


@register("stream_metrics", oracle.stream_metrics("event"))
def _stream_metrics(spark, sf):
    """M1-M3, M5, M6: counters (summed over micro-batches) and the last gauge value."""
    from cartwheel.streaming.metrics import counters
    return counters(_metric_replays(spark, sf))


@register("stream_rates", oracle.record_counts("event"))
def _stream_rates(spark, sf):
    """M7: records in and out of the three jobs."""
    from cartwheel.streaming.metrics import record_counts
    return record_counts(_metric_replays(spark, sf))


@register("stream_rates_per_second", None)
def _stream_rates_per_second(spark, sf):
    """M7: records in and out per second in each micro-batch of the three jobs. The values depend on the clock, so there is no SQL for them."""
    from cartwheel.streaming.metrics import RATES, rates
    return rates(_metric_replays(spark, sf)).where(F.col("name").isin(*RATES))


# --- distribution (A6, M4) --------------------------------------------------------------------------

def _distribution_sql() -> str:
    from cartwheel.operators.distribution import DEFAULT_QUANTILES, quantile_name
    return oracle.kpi_distribution("event", 1000, DEFAULT_QUANTILES, [quantile_name(q) for q in DEFAULT_QUANTILES])


@register("kpi_value_distribution", _distribution_sql())
def _kpi_value_distribution(spark, sf):
    """Distribution of the last 1000 KPI window averages (whole numbers)."""
    from cartwheel.operators.distribution import kpi_value_distribution
    d = kpi_value_distribution(realtime_kpis(event_feed(spark, sf)), 1000)
    return d.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@register("kpi_value_distribution_stream", _distribution_sql())
def _kpi_value_distribution_stream(spark, sf):
    """M4: the distribution over the windows a KPI stream replay emitted."""
    from cartwheel.operators.distribution import kpi_value_distribution
    from cartwheel.streaming.jobs import kpi_stream
    emitted = _replay(spark, sf, kpi_stream, "kpi", "kpi_dist_replay", MINUTE_SPANS)
    d = kpi_value_distribution(emitted, 1000)
    return d.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))
