"""S1 + T1: order streams.

* ``order_stream_from_kafka``: the orders topic from the earliest offset, value only, decoded
  with the S2 decoder (needs the Kafka connector on the classpath; the consumer group of the
  original jobs is replaced by the query's checkpoint).
* ``order_stream_from_files``: the same stream replayed from files (Parquet ``events`` rows, one
  file or a folder of part files, or JSON order messages) for offline use and tests. A path without
  files is an error, not an empty stream.
* ``with_event_time``: the watermark, max event time minus a fixed delay (10 s by default). Spark
  keeps one global watermark across partitions, so an idle partition never holds it back (the
  original's idleness setting has no counterpart).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.config import DEFAULT_WATERMARK_DELAY
from cartwheel.schemas import EVENT_TIME
from cartwheel.session import is_folder, use_utc
from cartwheel.sources.feeds import event_feed_from
from cartwheel.sources.messages import decode_order_messages

EVENTS_TABLE = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def with_event_time(events: DataFrame, delay: str = DEFAULT_WATERMARK_DELAY) -> DataFrame:
    return events.withWatermark(EVENT_TIME, delay)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream: ``path`` is a file, or a folder of which ``glob`` may choose files."""
    if not is_folder(spark, path):
        path, glob = path.rstrip("/").rsplit("/", 1)
    options = {"pathGlobFilter": glob} if glob else {}
    if not spark.read.schema(schema).options(**options).parquet(path).inputFiles():
        raise FileNotFoundError(f"no file matches {glob or '*'} in {path}")
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return spark.readStream.schema(schema).options(**options).parquet(path)


def order_stream_from_files(spark: SparkSession, path: str, glob: str | None = None,
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` rows of a Parquet table, a file or a folder, mapped to order events."""
    use_utc(spark)
    return event_feed_from(file_stream(spark, path, EVENTS_TABLE, glob, max_files_per_trigger))


def order_stream_from_json_files(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One JSON order message per line of text files, decoded (invalid messages dropped)."""
    use_utc(spark)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return decode_order_messages(r.load(directory), "value", observe=True)


def kafka_source_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                         max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """By default a stream stops when offsets it still needs are gone, instead of passing over them."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def order_stream_from_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
                            starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                            fail_on_data_loss: bool = True) -> DataFrame:
    use_utc(spark)
    opts = kafka_source_options(bootstrap_servers, topic, starting_offsets, max_offsets_per_trigger, fail_on_data_loss)
    raw = spark.readStream.format("kafka").options(**opts).load()
    return decode_order_messages(raw.select(F.col("value").cast("string").alias("value")), "value", observe=True)
