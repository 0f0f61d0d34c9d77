"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where the hash of the last 32 bytes has its top bits
zero. As the cut depends on those bytes only, the chunks around an insertion change and the others stay.
Chunks are compared by digest: the first copy (in the order of doc_id and position) stays, later ones go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import GOLDEN, batch_of, bytes_of, mixed, saved, sliced, table

CUT_BITS = 5            # a cut every 32 bytes on average, after the least length
LEAST = 32              # the hash's reach: a chunk's cut never depends on what stands before the chunk
MOST = 4096
GEAR = (mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * GOLDEN) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the last 32 bytes (of fewer at the start), 32 bits wide."""
    h = GEAR[data]
    for size in (1, 2, 4, 8, 16):
        h = h + np.concatenate([np.zeros(size, np.uint32), h[:-size] << np.uint32(size)])[:len(h)]
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each text its chunk ends, counted from the start of ``data``. Cuts keep characters whole."""
    cut = gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0
    inner = np.concatenate([(data[1:] & 0xC0) != 0x80, [True]]) if len(data) else cut
    places = np.flatnonzero(cut & inner) + 1
    which = np.searchsorted(places, offsets)
    places = places.tolist()
    out = []
    for d, (a, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        own, last = [], a
        for c in places[which[d]:which[d + 1]] + [e]:
            while c - last > MOST:
                last += MOST
                while data[last] & 0xC0 == 0x80:
                    last -= 1
                own.append(last)
            if c - last >= LEAST:
                own.append(c)
                last = c
        if last < e:
            own.append(e)
        out.append(own)
    return out


_CHUNK = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                    ("d1", pa.int64()), ("d2", pa.int64())])


def chunks(docs: DataFrame) -> DataFrame:
    """A row for each chunk of (doc_id, _h, text): place and 128-bit digest. Null and empty texts have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            data, offsets = bytes_of(batch.column("text"))
            ends = chunk_ends(data, offsets)
            raw = data.tobytes()
            starts = [s for o, e in zip(offsets.tolist(), ends) for s in [o, *e][:-1]]
            flat = [x for e in ends for x in e]
            digests = np.frombuffer(b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts, flat)]), np.int64)
            sizes = np.array([len(e) for e in ends])
            row = pa.array(np.repeat(np.arange(len(ends)), sizes))
            base = np.repeat(offsets[:-1], sizes)
            yield batch_of(_CHUNK, {"doc_id": batch.column("doc_id").take(row), "_h": batch.column("_h").take(row),
                                    "start": np.array(starts, np.int64) - base, "end": np.array(flat, np.int64) - base,
                                    "d1": digests[::2], "d2": digests[1::2]})

    id_type = docs.schema["doc_id"].dataType
    if id_type != T.LongType():
        raise ValueError("doc_id must be a long")
    return docs.select("doc_id", "_h", "text").mapInArrow(run, "doc_id long, _h long, start int, end int, d1 long, d2 long")


KEPT = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType())]


def cut_out(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Take byte spans out of texts. ``spans`` has one row for each (doc_id, _h) with an array of
    struct<start, end>, in any order, overlaps allowed; documents (doc_id, _h, text) without a row
    lose nothing. Adds n_bytes, n_removed, n_spans (maximal runs) and ``kept`` (what is left, in bytes)."""
    joined = docs.join(spans.withColumnsRenamed({"doc_id": "_id", "_h": "_k"}),
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_k")), "left").drop("_id", "_k", "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            data, offsets = bytes_of(batch.column("text"))
            raw, total, removed, runs, kept = data.tobytes(), [], [], [], []
            for a, e, own in zip(offsets.tolist(), offsets[1:].tolist(), batch.column("spans").to_pylist()):
                text, out, last, gone, n = raw[a:e], [], 0, 0, 0
                end = -1
                for s in sorted((x["start"], x["end"]) for x in own or ()):
                    if s[0] > end:
                        n += 1
                        out.append(text[last:s[0]])
                    gone += max(0, s[1] - max(s[0], end, 0))
                    end = last = max(end, s[1])
                total.append(e - a)
                removed.append(gone)
                runs.append(n)
                kept.append(b"".join([*out, text[last:]]))
            columns = {c: batch.column(c) for c in batch.schema.names if c != "spans"}
            columns |= {"n_bytes": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                        "n_spans": pa.array(runs, pa.int64()), "kept": pa.array(kept, pa.binary())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    fields = [f for f in joined.schema.fields if f.name != "spans"]
    return joined.mapInArrow(run, T.StructType(fields + KEPT))


def dedup_chunks(docs: DataFrame) -> DataFrame:
    """Documents (doc_id long, text) with repeated chunks taken out: doc_id, text, n_bytes, n_removed,
    n_spans, kept (the bytes left, whole characters).

    Of chunks with equal bytes the one in the smallest doc_id stays (null first), there the first.
    Rows equal in doc_id and text count as one document and get the same result. Texts shorter than a
    chunk's least length are one chunk. Null is empty; no rows give no rows. Other columns are not
    carried.

    Chunks whose 64-bit half digest occurs once anywhere, most of them, leave after a count of
    numbers of 8 bytes; counts are summed before the shuffle, so copies do not make a task large."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    every = chunks(docs)
    often = every.groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1")
    some = saved(every.join(often, "d1"), "chunks")
    place = F.struct("doc_id", "_h", "start")
    first = some.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = some.join(first, ["d1", "d2"]).where(~place.eqNullSafe(F.col("first")))
    spans = later.groupBy("doc_id", "_h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return cut_out(docs, spans)


def op8_chunk_dedup(spark, sf_dir):
    """What is left of each document when repeated chunks go."""
    out = dedup_chunks(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
