"""W3 in a stream: state per group of customers and time bucket with one event-time timer.

A call of the state function costs milliseconds whatever it holds, so many customers share a state: their number of calls is
bounded however many there are. State per group, by customer:
* ``pending``: times of events that arrived but are not yet behind the watermark, so an earlier
  event may still come; they are not judged yet.
* ``recent``: times of judged events inside the last ``span`` (all a future run can reach).

Input: events at or below the current watermark are late and dropped (the engine's late filter
lags one micro-batch; dropping here makes the result independent of batch boundaries). The one
timer sits at the earliest pending time. When the watermark passes it, every pending event at or
below the watermark is judged in time order: its longest run ``K`` is 1 + the number of recent
times inside ``(t - span, t]``. Events of equal time share their detection time, so their order
cannot change the alerts and only times are kept. Afterwards the timer moves to the next pending
event of any of the customers, or, with nothing pending, to the moment the last recent time leaves the span, when the state
is dropped.

The function returns one row (time, K) per event; the run lengths ``min_count..K`` are exploded in the
JVM, so what travels through Python is linear in the events although the alerts are not.

As in the batch form, a group has the events of one time bucket, and those within ``span`` of a
bucket's end go to the next bucket too, where they only count. So one customer with a large share
of a micro-batch is dealt to many tasks. State is bounded by the events of the group's customers inside a
bucket and ``span`` plus those inside the watermark delay.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import DEFAULT_BURST_SPAN, DEFAULT_SUSPICIOUS_ORDER_COUNT
from cartwheel.functions.columns import span_microseconds
from cartwheel.operators.bursts import alerts_from_runs
from cartwheel.schemas import EVENT_TIME
from cartwheel.streaming import burst_groups, burst_processor
from cartwheel.streaming.burst_groups import RUN_DDL, STATE_DDL, make_burst_function
from cartwheel.streaming.burst_processor import BurstProcessor

# Wider than in a batch: a micro-batch covers little time, each bucket of a customer is a state of its own, and so are the copies near its end.
BUCKET_SPANS = 64

# Groups of customers that share a state in each bucket, by a hash. Checkpoints depend on it; more give more tasks and more calls.
CUSTOMER_GROUPS = 512

cloudpickle.register_pickle_by_value(sys.modules[burst_groups.__name__])
cloudpickle.register_pickle_by_value(sys.modules[burst_processor.__name__])


def suspicious_frequency_stream(events: DataFrame, min_count: int = DEFAULT_SUSPICIOUS_ORDER_COUNT,
                                span: str = DEFAULT_BURST_SPAN) -> DataFrame:
    """Burst alerts of a watermarked order stream (append mode).

    Events without a customer are dropped inside the state function, not by a filter in front
    of it, which Catalyst would push below the watermark (a filter on the event time itself
    stays above it)."""
    span_us = span_microseconds(span)
    bucket_us = BUCKET_SPANS * span_us
    by_group = _in_buckets(events, span_us, bucket_us).withColumn("customers", F.pmod(F.xxhash64("customer_id"), F.lit(CUSTOMER_GROUPS)))
    ends = by_group.groupBy("customers", "bucket").applyInPandasWithState(
        make_burst_function(min_count, span_us, bucket_us), RUN_DDL, STATE_DDL, "append", "EventTimeTimeout")
    return _alerts(ends, min_count, span)


def _in_buckets(events: DataFrame, span_us: int, bucket_us: int) -> DataFrame:
    """Event times with their customer and bucket; those within the span of a bucket's end in the next one too."""
    src = (events.where(F.col(EVENT_TIME).isNotNull())
                 .select("customer_id", EVENT_TIME, F.unix_micros(EVENT_TIME).alias("ts_us")))
    home = F.expr(f"(ts_us - pmod(ts_us, {bucket_us})) div {bucket_us}")
    in_halo = F.col("ts_us") > (home + 1) * F.lit(bucket_us) - F.lit(span_us)
    return src.withColumn("bucket", F.explode(F.when(in_halo, F.array(home, home + 1)).otherwise(F.array(home))))


def _alerts(ends: DataFrame, min_count: int, span: str) -> DataFrame:
    runs = ends.select("customer_id", F.timestamp_micros("ts_us").alias(EVENT_TIME),
                       F.explode(F.sequence(F.lit(min_count).cast("long"), F.col("k"))).alias("run_length"))
    return alerts_from_runs(runs, span)


def suspicious_frequency_processor(events: DataFrame, min_count: int = DEFAULT_SUSPICIOUS_ORDER_COUNT, span: str = DEFAULT_BURST_SPAN,
                                   restore: str | None = None) -> DataFrame:
    """The same alerts by a state processor (``transformWithStateInPandas``: lists of times, one event-time timer a key).
    Needs a RocksDB state store when the query starts, as ``build_session`` sets it (``session.STATE_DEFAULTS``).

    ``restore`` is the checkpoint of a stopped query of this function with the same span and count. The new query, on a checkpoint of
    its own, goes on from that state and watermark, with any number of state partitions; ``events`` are those which the
    stopped query had not read."""
    span_us = span_microseconds(span)
    bucket_us = BUCKET_SPANS * span_us
    spark = events.sparkSession
    state = burst_state(spark, restore).groupBy("customer_id", "bucket") if restore else None
    processor = BurstProcessor(min_count, span_us, bucket_us, last_watermark_ms(spark, restore) if restore else 0)
    ends = _in_buckets(events, span_us, bucket_us).groupBy("customer_id", "bucket").transformWithStateInPandas(processor, RUN_DDL, "append", "eventTime", state)
    return _alerts(ends, min_count, span)


def burst_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of a stopped processor query, by the state data source: customer_id, bucket, kind (pending or recent), ts_us."""
    def times(kind: str) -> DataFrame:
        read = spark.read.format("statestore").option("stateVarName", kind).load(checkpoint)
        return read.select("key.customer_id", "key.bucket", F.lit(kind).alias("kind"), "list_element.ts_us")
    return times("pending").unionByName(times("recent"))


def last_watermark_ms(spark: SparkSession, checkpoint: str) -> int:
    """The watermark at which the next micro-batch of a stopped query would run, by its logs of offsets and commits."""
    path = checkpoint.rstrip("/")
    logs = spark.read.text([f"{path}/offsets", f"{path}/commits"])
    told = F.coalesce(F.get_json_object("value", "$.nextBatchWatermarkMs"), F.get_json_object("value", "$.batchWatermarkMs"))
    return logs.where(F.col("value").startswith("{")).agg(F.coalesce(F.max(told.cast("long")), F.lit(0))).first()[0]
