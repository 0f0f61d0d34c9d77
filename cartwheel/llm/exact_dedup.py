"""Exact deduplication as a stream with keyed state.

Documents arrive in micro-batches. The state, on disk (RocksDB) and never expired, keeps for each digest of the
normalised text the document that stays (identifier and content locator: file and row) and how many
there were. The state is then read back, and every hit is checked: its full normalised text is compared with that of the
document found by the locator. Texts that differ in spite of equal digests are grouped by their bytes.

The main path is DataFrame operations only.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import saved, table
from cartwheel.session import scratch_path

TRIGGERS = 4            # micro-batches for what is there at the start
_OWN = {"doc_id", "keep_id", "group_size", "kept", "text_sha256", "digest", "rank", "norm", "best", "n", "own", "d", "d2", "r2", "group"}
_STATE = "spark.sql.streaming.stateStore"
_SETTINGS = {f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
             f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
             f"{_STATE}.rocksdb.allowFAllocate": "false"}      # else each of many small stores takes megabytes ahead


def normalised(text: str = "text") -> Column:
    """The text without the characters [\\x20\\x09-\\x0D]; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def _rank(text: str = "text") -> Column:
    """What decides which copy stays: most code points of the text, then the smallest doc_id (null last); ties by place."""
    return F.struct(F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"), (-F.col("doc_id")).alias("id"),
                    F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


@contextmanager
def _disk_state(spark: SparkSession):
    old = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def keepers_stream(docs: DataFrame) -> DataFrame:
    """A stream of documents as a stream of (digest, best, n): a running aggregate whose state is the whole memory of
    the deduplication. Batches are aggregated before the shuffle, so a large group of copies is a few rows."""
    return (docs.select(F.sha2(normalised(), 256).alias("digest"), _rank().alias("rank"))
            .groupBy("digest").agg(F.max("rank").alias("best"), F.count("*").alias("n")))


def open_stream(spark: SparkSession, path: str, triggers: int = TRIGGERS) -> DataFrame:
    """The table at ``path``, a Parquet file or a folder of them, as a stream of about ``triggers`` micro-batches."""
    batch = spark.read.parquet(path)
    files = len(batch.inputFiles())
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", max(1, -(-files // triggers)))
    if system.getFileStatus(location).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", location.getName()).parquet(path.rsplit("/", 1)[0])


def run_state(spark: SparkSession, path: str, checkpoint: str, triggers: int = TRIGGERS) -> DataFrame:
    """Bring the state in ``checkpoint`` up to date with all files of the table and return it: digest, best, n. A
    run that was stopped, or a table that has new files, goes on from the same checkpoint."""
    with _disk_state(spark):
        query = (keepers_stream(open_stream(spark, path, triggers)).writeStream.format("noop").outputMode("update")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        value = state.schema["value"].dataType.names
        return saved(state.select(F.col("key.digest").alias("digest"), F.col(f"value.{value[0]}").alias("best"),
                                  F.col(f"value.{value[1]}").alias("n")), "dedup-state")


def exact_dedup(spark: SparkSession, path: str, checkpoint: str | None = None, triggers: int = TRIGGERS, columns: tuple[str, ...] = ()) -> DataFrame:
    """Every document of the table at ``path`` (doc_id long, text, any others): doc_id, keep_id, group_size, kept,
    text_sha256, and ``columns`` of the table.

    Texts are equal if they are so without the characters [\\x20\\x09-\\x0D]; null counts as empty, and
    all empty texts are one group. The row with the most code points stays, then the smallest doc_id, a
    row without doc_id last; keep_id is null if no row of the group has one. Exactly one row of a group
    stays, also among rows that are equal in every column. No rows give no rows. ``columns`` that are named like one of the
    result or of its making are refused."""
    if clash := _OWN & {c.lower() for c in columns}:
        raise ValueError(f"columns {sorted(clash)} are made here")
    checkpoint = checkpoint or scratch_path(spark, "dedup-stream")
    state = run_state(spark, path, checkpoint, triggers)
    batch = spark.read.parquet(path)
    rows = batch.select(*columns, "doc_id", F.sha2(normalised(), 256).alias("digest"), _rank().alias("rank"), normalised().alias("norm"))
    # hits: full bytes against those at the locator
    hits = rows.join(state.where("n > 1"), "digest").select("digest", "rank", "best", "norm")
    place = hits.select("digest", "rank", "norm", ((F.col("rank.file") == F.col("best.file")) & (F.col("rank.row") == F.col("best.row"))).alias("found"))
    hits = saved(place, "dedup-hits")
    there = hits.where("found").select("digest", F.col("norm").alias("kept_norm"))
    other = saved(hits.where("NOT found").join(there, "digest").where("norm <> kept_norm").select("digest", "norm", "rank"), "dedup-collisions")
    own = F.lit(None).cast("string")
    if not other.isEmpty():     # equal digests of different bytes: group by the bytes
        apart = other.groupBy("digest", "norm").agg(F.max("rank").alias("best"), F.count("*").alias("n"))
        less = apart.groupBy("digest").agg(F.sum("n").alias("gone"))
        groups = (state.join(less, "digest", "left").select("digest", F.lit(None).cast("string").alias("norm"), "best",
                                                            (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"))
                  .unionByName(apart))
        different = other.select(F.col("digest").alias("d2"), F.col("rank").alias("r2"))
        rows = rows.join(different, (F.col("digest") == F.col("d2")) & (F.col("rank.file") == F.col("r2.file"))
                         & (F.col("rank.row") == F.col("r2.row")), "left")
        own = F.when(F.col("d2").isNotNull(), F.col("norm"))
    else:
        groups = state.withColumn("norm", F.lit(None).cast("string"))
    narrow = rows.select(*columns, "doc_id", "digest", "rank", own.alias("own"))
    joined = narrow.join(groups.withColumnsRenamed({"digest": "d", "norm": "group"}), (F.col("digest") == F.col("d")) & F.col("own").eqNullSafe(F.col("group")))
    kept = (F.col("rank.file") == F.col("best.file")) & (F.col("rank.row") == F.col("best.row"))
    return joined.select(*columns, "doc_id", (-F.col("best.id")).alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"),
                         F.col("digest").alias("text_sha256"))


def op6_exact_dedup(spark, sf_dir):
    """The copy that stays of every text, for all documents."""
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


OP6_SQL = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h,
                  row_number() OVER () AS r FROM documents),
w AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY chars DESC, doc_id NULLS LAST, r) AS place FROM d)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY h ORDER BY place) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       place = 1 AS kept, h AS text_sha256 FROM w
"""
