"""Session helpers: the settings every job relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit state as a changelog per micro-batch instead of uploading snapshots every time
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Event times are UTC instants; windows and text formats assume a UTC session.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only on measured sizes: no broadcast from file-size estimates at planning time;
    # AQE turns a shuffle join into a broadcast join when the finished map stage of a side is
    # below the threshold (its size is then known, not estimated)
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    **STATE_DEFAULTS,
}

MB = 1024 * 1024


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int,
                     shuffle_ratio: float = 0.3, target_split_mb: int = 256,
                     target_shuffle_mb: int = 200) -> dict[str, str]:
    """Partition sizing for a cluster run.

    * input splits of ``target_split_mb`` (Parquet row groups permitting);
    * shuffle partitions so that a partition holds about ``target_shuffle_mb`` of shuffle data
      (``shuffle_ratio`` x input: the burst and join shuffles carry narrow rows, windows and KPIs
      far less after partial aggregation), at least 2 per core; AQE coalesces small ones and
      splits skewed ones at run time;
    * the same number fixes the state partitions of a stream at its first start.

    Example: 100 TB on 1000 executors x 8 cores -> 256 MB splits (~400k tasks, 50 waves) and
    ~157k shuffle partitions."""
    cores = executors * cores_per_executor
    shuffle = max(2 * cores, int(input_bytes * shuffle_ratio / (target_shuffle_mb * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_split_mb * MB),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_shuffle_mb * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_shuffle_mb * MB),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
        "spark.default.parallelism": str(2 * cores),
    }


def build_session(master: str | None = None, app: str = "cartwheel", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's defaults. The master and the number of shuffle partitions come
    from the submit (or Spark's defaults) unless they are given here, as local runs and tests do."""
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone: timestamp_ntz <-> timestamp casts and text formats depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a block of code; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a reliable, shared file system). Only when it is unset,
    as in local tests, a private temporary folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared, reliable folder (e.g. on HDFS/S3)")
        d = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one query run (checkpoints, tables)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system Spark knows is a folder; an error if it does not exist."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(location):
        raise FileNotFoundError(path)
    return system.getFileStatus(location).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def make_folder(spark: SparkSession, path: str) -> str:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(location)
    return path

