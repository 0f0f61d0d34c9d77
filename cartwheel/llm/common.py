"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cartwheel
from cartwheel.session import scratch_path

# Text handled at once inside a task: bounds the arrays of 8 bytes per text byte that the kernels
# allocate. A longer text is handled alone.
SLICE_BYTES = 1 << 20

# 64-bit odd constants of the hash kernels (splitmix64's multipliers and golden ratio).
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, one file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: the functions that run in tasks
    import it. The archive lies in the shared checkpoint folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(cartwheel.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for f in sorted(root.rglob("*.py")):
            archive.write(f, f.relative_to(root.parent))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path.toString())
    _SHIPPED.add(context.applicationId)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared checkpoint folder and read it back: cuts the lineage, and
    every later use reads the same rows even if executors are lost in between."""
    return df.sparkSession.read.schema(df.schema).parquet(save(df, name))


def save(df: DataFrame, name: str) -> str:
    """Write a frame to a new folder in the shared checkpoint folder and return its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def drop_saved(df: DataFrame) -> None:
    """Delete the files of a frame that ``saved`` made and no later step reads."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of at most ``limit`` text bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = bytes_of(batch.column(text))[1]
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), batch.num_rows)
            yield batch.slice(i, j - i)
            i = j


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column one after the other, and n + 1 offsets from 0. Null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher: spreads every input bit over the 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= MIX1
    x ^= x >> np.uint64(27)
    x *= MIX2
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n (grown in powers of two)."""
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1 << 16
    if size not in _POWERS:
        _POWERS.clear()
        inverse = pow(BASE, -1, 1 << 64)
        _POWERS[size] = tuple(
            np.concatenate([np.ones(1, np.uint64),
                            np.cumprod(np.full(size, np.uint64(b)), dtype=np.uint64)])
            for b in (BASE % (1 << 64), inverse))
    return _POWERS[size]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P with P[i] the polynomial hash of data[:i] modulo 2 ** 64; see ``span_hashes``."""
    up, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes, whatever stands around them."""
    _, down = _powers(len(prefix) - 1)
    raw = (prefix[ends] - prefix[starts]) * down[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * GOLDEN)


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type)
         for n, c in ((f.name, columns[f.name]) for f in schema)], schema=schema)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
