"""Exactly-once output of micro-batches: staged files and one commit entry for each batch.

A result folder has one layout, whether it is the only output of a query or one of several:

    <folder>/batch_id=<n>/part-*.parquet     the rows of micro-batch n; a batch that runs again replaces its folder
    <folder>/_commits/<n>                    made, in one step, when the files of batch n are complete

Batches of a query follow one another, so the entries before the last say nothing more and go. ``read_committed`` reads the batches up to the
last entry: never half a batch, none twice, none lost.

A plain Parquet table of the catalog is read by anyone, without such entries. Its batches are written to a
staging folder first; complete files are then renamed into the table under names that they keep if the batch runs again. So a driver that
dies at any point leaves either files that the next attempt writes anew, or ones that it finds and
passes over.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


def _system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, location = _system(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(location)] if system.exists(location) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _system(spark, path)
    return system.exists(location)


def refuse_other_layout(spark: SparkSession, folder: str) -> None:
    """A folder that Spark's own file sink wrote has a log that readers follow: files without an entry there would be invisible."""
    if exists(spark, f"{folder.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{folder} was written by another kind of sink (it has _spark_metadata); choose a new folder")


def last_committed(spark: SparkSession, folder: str) -> int:
    """The last batch with an entry; -1 if there is none."""
    return max((int(n) for n in _names(spark, f"{folder.rstrip('/')}/_commits") if n.isdigit()), default=-1)


def commit(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Make the entry of a batch; the older ones but one go afterwards."""
    entries = f"{folder.rstrip('/')}/_commits"
    system, location = _system(spark, f"{entries}/{batch_id}")
    system.mkdirs(location.getParent())
    system.createNewFile(location)
    for name in _names(spark, entries):
        if name.isdigit() and int(name) < batch_id - 1:
            system.delete(_system(spark, f"{entries}/{name}")[1], False)


def write_committed(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Write a micro-batch and commit it; nothing if it is committed already."""
    spark, folder = rows.sparkSession, folder.rstrip("/")
    if batch_id <= last_committed(spark, folder):
        return
    refuse_other_layout(spark, folder)
    rows.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")
    commit(spark, folder, batch_id)


def read_committed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches; the entry is looked up when this is called."""
    folder = folder.rstrip("/")
    last = last_committed(spark, folder)
    if last < 0:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(whole).parquet(folder).where(F.col(BATCH) <= last).drop(BATCH)


# plain Parquet tables of the catalog ---------------------------------------------------------------

def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name}


def is_plain_table(spark: SparkSession, table: str) -> bool:
    about = _described(spark, table)
    return about.get("Provider", "").lower() == "parquet" and "Location" in about


def append_once(rows: DataFrame, table: str, staging: str, name: str) -> None:
    """Append rows to a plain Parquet table, once however often this is called with one ``staging`` folder. ``name`` begins the names of
    the files: one for each query and batch. The renames are a few for each batch, one for each file."""
    spark, staging = rows.sparkSession, staging.rstrip("/")
    if exists(spark, f"{staging}/_published"):
        return
    target = _described(spark, table)["Location"].rstrip("/")
    refuse_other_layout(spark, target)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not exists(spark, f"{staging}/files/_SUCCESS"):
        columns = spark.table(table).columns
        rows.toDF(*columns).write.mode("overwrite").partitionBy(*parts).parquet(f"{staging}/files")
    publish(spark, f"{staging}/files", target, name)
    if parts:
        days = {inner for inner, _ in _data_files(spark, target, name) if inner}
        for inner in sorted(days):
            spec = ", ".join("{}='{}'".format(*p.split("=", 1)) for p in inner.split("/"))
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)
    system, location = _system(spark, f"{staging}/_published")
    system.createNewFile(location)
    system.delete(_system(spark, f"{staging}/files")[1], True)


def publish(spark: SparkSession, staged: str, target: str, name: str) -> None:
    """Move complete files; one that was moved before is not staged any more."""
    for inner, file in list(_data_files(spark, staged)):
        system, source = _system(spark, "/".join(filter(None, (staged, inner, file))))
        _, place = _system(spark, "/".join(filter(None, (target, inner, f"{name}-{file}"))))
        system.mkdirs(place.getParent())
        if not system.rename(source, place):
            raise OSError(f"cannot move {source} to {place}")


def _data_files(spark: SparkSession, folder: str, prefix: str = "part-") -> Iterator[tuple[str, str]]:
    """(folder inside, name) of the files whose names begin so; the folders are those of partitions."""
    system, location = _system(spark, folder)
    todo = [(location, "")] if system.exists(location) else []
    while todo:
        place, inner = todo.pop()
        for s in system.listStatus(place):
            own = s.getPath().getName()
            if s.isDirectory() and "=" in own:
                todo.append((s.getPath(), f"{inner}/{own}".strip("/")))
            elif own.startswith(prefix):
                yield inner, own
