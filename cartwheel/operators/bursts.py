"""Suspicious order frequency, batch form.

Semantics: per customer, events in event-time order (ties by order_id, product_id). Every
contiguous run of at least ``min_count`` events whose last and first times differ by less than
``span`` gives one alert, detected at the run's last event. So an event ``e`` ends runs of
lengths ``min_count .. K(e)``, where ``K(e)`` is the number of events of the same customer in
``(t_e - span, t_e]`` up to and including ``e``.

Plan (no self-join, no pairs):
* Events of one customer at one instant are pre-aggregated to a count ``m`` (partial counts
  before the shuffle, so a burst of simultaneous events is one row). The ``m`` events at ``t``
  have ``K = before + 1 .. before + m``, where ``before`` is the number of events in
  ``(t - span, t)``: a running sum of ``m`` minus the sum over ``t' <= t - span``. Both are RANGE
  frames from UNBOUNDED PRECEDING over one sort, which Spark evaluates incrementally (no
  sliding-frame recomputation). Which of the tied events gets which ``K`` does not matter: they
  share their detection time.
* Groups are ``(customer, time bucket)``, not whole customers: a customer's events are split into
  buckets of ``bucket`` width (>= span; default 8 x span), and the events within ``span`` of a
  bucket's end are copied into the next bucket as context ("halo", about span/bucket of the rows).
  Only a bucket's own events emit alerts. A customer holding a large share of all rows is thus
  spread over many tasks; one group holds at most the events of one customer in
  ``bucket + span``, and since a group of ``n`` events inside the span already yields about
  n^2/2 alerts, a group can never be large relative to the output it has to produce.
* The run lengths are produced by ``explode(sequence(min_count, K))`` per event; the runs
  themselves are never materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.config import DEFAULT_BURST_SPAN, DEFAULT_SUSPICIOUS_ORDER_COUNT
from cartwheel.functions.columns import span_microseconds, span_text
from cartwheel.schemas import AMOUNT, BURST_DESCRIPTION, EVENT_TIME, SUSPICIOUS_FREQUENCY

BUCKET_SPANS = 8


def burst_run_ends(events: DataFrame, min_count: int = DEFAULT_SUSPICIOUS_ORDER_COUNT,
                   span: str = DEFAULT_BURST_SPAN, bucket: str | None = None) -> DataFrame:
    """One row per (customer, event time) that ends at least one run:
    customer_id, ts_us, before (events of the customer in ``(t - span, t)``), m (events at ``t``).

    The j-th of the m events at ``t`` (in any tie order) has ``K = before + j``."""
    if min_count < 1:
        raise ValueError("min_count must be >= 1")
    span_us = span_microseconds(span)
    bucket_us = span_microseconds(bucket) if bucket else BUCKET_SPANS * span_us
    if bucket_us < span_us:
        raise ValueError("bucket must be at least as wide as span")

    ev = (events
          .where(F.col("customer_id").isNotNull() & F.col(EVENT_TIME).isNotNull())
          .select("customer_id", F.unix_micros(F.col(EVENT_TIME)).alias("ts_us")))
    # floor(ts_us / bucket_us) in exact integer arithmetic (also for times before 1970)
    home_bucket = F.expr(f"(ts_us - pmod(ts_us, {bucket_us})) div {bucket_us}")
    in_halo = F.col("ts_us") > (home_bucket + 1) * F.lit(bucket_us) - F.lit(span_us)
    ev = ev.withColumn("bucket", F.explode(
        F.when(in_halo, F.array(home_bucket, home_bucket + 1)).otherwise(F.array(home_bucket))))
    # pre-aggregate events of one customer at one instant (partial counts before the shuffle)
    ties = ev.groupBy("customer_id", "bucket", "ts_us").agg(F.count(F.lit(1)).alias("m"))

    by_time = Window.partitionBy("customer_id", "bucket").orderBy("ts_us")
    upto = F.sum("m").over(by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    older = F.sum("m").over(by_time.rangeBetween(Window.unboundedPreceding, -span_us))
    before = upto - F.col("m") - F.coalesce(older, F.lit(0))
    return (ties.withColumn("before", before)
                .where((F.col("bucket") == home_bucket) & (F.col("before") + F.col("m") >= min_count))
                .select("customer_id", "ts_us", "before", "m"))


def suspicious_frequency_alerts(events: DataFrame, min_count: int = DEFAULT_SUSPICIOUS_ORDER_COUNT,
                                span: str = DEFAULT_BURST_SPAN, bucket: str | None = None) -> DataFrame:
    """One alert per run: entity = customer, description ``{n} orders in less than {span}``,
    value null, detected_at = time of the run's last event."""
    ends = burst_run_ends(events, min_count, span, bucket)
    # j-th tied event: K = before + j; it ends runs of lengths min_count..K
    first_k = F.greatest(F.col("before") + 1, F.lit(min_count).cast("long"))
    k = ends.select("customer_id", "ts_us", F.explode(F.sequence(first_k, F.col("before") + F.col("m"))).alias("k"))
    runs = k.select("customer_id", F.timestamp_micros("ts_us").alias(EVENT_TIME),
                    F.explode(F.sequence(F.lit(min_count).cast("long"), F.col("k"))).alias("run_length"))
    return alerts_from_runs(runs, span)


def alerts_from_runs(runs: DataFrame, span: str = DEFAULT_BURST_SPAN) -> DataFrame:
    """(customer_id, order_purchase_timestamp, run_length) -> alert rows."""
    return runs.select(
        F.lit(SUSPICIOUS_FREQUENCY).alias("alert_type"),
        F.col("customer_id").alias("entity_id"),
        F.concat(F.col("run_length").cast("string"), F.lit(BURST_DESCRIPTION + span_text(span))).alias("description"),
        F.lit(None).cast(AMOUNT).alias("value"),
        F.col(EVENT_TIME).alias("detected_at"))
