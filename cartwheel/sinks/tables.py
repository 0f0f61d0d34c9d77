"""K5-K9: typed result tables.

* ``to_*_rows`` coerce a result to its table schema (K9): decimals to decimal(12,2) with HALF_UP
  rounding and null on overflow (``try_cast``), strings and timestamps as they are. Revenue rows get
  the partition column exactly if the target table has it.
* ``create_result_tables`` creates the three tables if absent (K8). With a catalog that supports
  transforms (``table_format='iceberg'``) revenue is partitioned by ``days(window_start)``; with
  plain Parquet a derived ``window_date`` column is the partition column, and
  ``read_revenue`` adds the matching ``window_date`` filter so that time-range reads prune files.
* ``append_*`` write a batch (K5-K7); streams use the same coercion in ``foreachBatch`` or
  ``writeStream.toTable`` (see ``cartwheel.streaming.jobs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import TABLE_ALERTS, TABLE_DATABASE, TABLE_KPIS, TABLE_REVENUE
from cartwheel.functions.columns import money
from cartwheel.schemas import ALERT_TABLE, KPI_TABLE, REVENUE_TABLE

PARTITION_COLUMN = "window_date"


def _coerce(df: DataFrame, schema) -> DataFrame:
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        c = money(c) if f.dataType.typeName() == "decimal" else c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_revenue_rows(revenue: DataFrame, partition_column: bool = True) -> DataFrame:
    rows = _coerce(revenue, REVENUE_TABLE)
    return rows.withColumn(PARTITION_COLUMN, F.to_date("window_start")) if partition_column else rows


def to_kpi_rows(kpis: DataFrame) -> DataFrame:
    return _coerce(kpis, KPI_TABLE)


def to_alert_rows(alerts: DataFrame) -> DataFrame:
    return _coerce(alerts, ALERT_TABLE)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def create_result_tables(spark: SparkSession, database: str = TABLE_DATABASE, table_format: str = "parquet",
                         location: str | None = None) -> list[str]:
    """CREATE TABLE IF NOT EXISTS for the three result tables; returns their names. ``database`` may
    carry a catalog prefix (``catalog.database``)."""
    db_loc = f" LOCATION '{location.rstrip('/')}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{db_loc}")
    loc = (lambda t: f" LOCATION '{location.rstrip('/')}/{t}'") if location else (lambda t: "")
    if table_format == "iceberg":
        rev_part = "PARTITIONED BY (days(window_start))"
        rev_cols = _ddl(REVENUE_TABLE)
    else:
        rev_part = f"PARTITIONED BY ({PARTITION_COLUMN})"
        rev_cols = _ddl(REVENUE_TABLE) + f", {PARTITION_COLUMN} date"
    names = []
    for table, cols, part in [(TABLE_REVENUE, rev_cols, rev_part), (TABLE_KPIS, _ddl(KPI_TABLE), ""),
                              (TABLE_ALERTS, _ddl(ALERT_TABLE), "")]:
        name = f"{database}.{table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {table_format} {part}{loc(table)}")
        names.append(name)
    return names


def has_partition_column(spark: SparkSession, table: str) -> bool:
    return PARTITION_COLUMN in spark.table(table).columns


def append_revenue(revenue: DataFrame, table: str) -> None:
    # Clustered by day, so that a day is a few files instead of one per task; a rebalance, unlike a
    # repartition, may be split by AQE where one day is large.
    rows = to_revenue_rows(revenue, has_partition_column(revenue.sparkSession, table))
    day = F.col(PARTITION_COLUMN) if PARTITION_COLUMN in rows.columns else F.to_date("window_start")
    rows.hint("rebalance", day).write.insertInto(table)


def append_kpis(kpis: DataFrame, table: str) -> None:
    to_kpi_rows(kpis).write.insertInto(table)


def append_alerts(alerts: DataFrame, table: str) -> None:
    to_alert_rows(alerts).write.insertInto(table)


def read_revenue(spark: SparkSession, table: str, start=None, end=None) -> DataFrame:
    """Revenue rows with ``start <= window_start < end``; the date filter prunes partitions."""
    df = spark.table(table)
    if start is not None:
        df = df.where((F.col("window_start") >= F.lit(start)) &
                      (F.col(PARTITION_COLUMN) >= F.to_date(F.lit(start))))
    if end is not None:
        df = df.where((F.col("window_start") < F.lit(end)) &
                      (F.col(PARTITION_COLUMN) <= F.to_date(F.lit(end))))
    return df
