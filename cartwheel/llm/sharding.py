"""Contiguous shards of near equal bytes, from global prefix sums.

Rows are put in a global order by range partitioning. Each partition gives one total (bytes and
rows); the running sums of those few totals are the offsets from which every partition numbers its
own rows, so no task ever sees more than its own range. A row's shard is where the middle of its
bytes falls among equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import saved, shuffle_partitions, table, text_or_empty

SHARDS = 24
ROW_BYTES = 8


def shard_by_bytes(rows: DataFrame, size: str, order: list[str], shards: int) -> DataFrame:
    """Add ``shard`` (0 .. shards - 1) and ``slot`` (gapless from 0 in each shard) to the rows.

    ``size`` names a long column (null counts as 0), ``order`` the columns of the global order. Rows equal in all
    of ``order`` may change places with each other; give columns that tell rows apart. Nulls sort
    first. No rows give no shards; if all sizes are 0 the rows are cut by count instead. A shard is
    off its target by at most the largest row at each end; shards can be empty if there are fewer
    rows than shards. Other columns stay; names that clash are refused."""
    if clash := {"shard", "slot", "_part", "_row", "_byte", "_b", "_n", "_byte0", "_row0", "_bytes", "_rows", "_first"} & {c.lower() for c in rows.columns}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    spark = rows.sparkSession
    weight = F.coalesce(F.col(size), F.lit(0).cast("long"))
    ranged = saved(rows.repartitionByRange(shuffle_partitions(spark), *order)
                   .withColumn("_part", F.spark_partition_id()), "shard-ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the only global window
    starts = (ranged.groupBy("_part").agg(F.sum(weight).alias("_b"), F.count("*").alias("_n"))
              .select(F.col("_part"),
                      F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_byte0"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_row0"),
                      F.sum("_b").over(Window.partitionBy()).alias("_bytes"),
                      F.sum("_n").over(Window.partitionBy()).alias("_rows")))
    inside = Window.partitionBy("_part").orderBy(*order)
    placed = (ranged.join(starts, "_part")
              .withColumn("_row", F.col("_row0") + F.row_number().over(inside) - 1)
              .withColumn("_byte", F.col("_byte0") + F.coalesce(
                  F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("shard", F.when(
                  F.col("_bytes") > 0,
                  F.expr(f"least({shards - 1}L, ((2 * _byte + coalesce(`{size}`, 0L)) * {shards}) div (2 * _bytes))"))
                  .otherwise(F.expr(f"(_row * {shards}) div _rows")).cast("int")))
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))   # at most `shards` rows
    return (placed.join(firsts, "shard").withColumn("slot", F.col("_row") - F.col("_first"))
            .select(*rows.columns, "shard", "slot"))


def op5_sharding(spark, sf_dir):
    """All documents in 24 shards by the law ``bytes``."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text_or_empty()) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))
    return shard_by_bytes(rows, "size", ["doc_id", "text_crc32", "size"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))

