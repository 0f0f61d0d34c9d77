"""Benchmark decontamination with one FM-index per shard of training text.

A shard is up to ``SHARD_BYTES`` of consecutive documents inside one task. Its words become
numbers; a word that no test item has cannot be part of an occurrence and becomes the separator, so
the index holds only runs of test words long enough for a phrase. The index is the usual one: suffix
array, Burrows-Wheeler transform, wavelet matrix for ranks, and every ``SAMPLE``-th text position
kept. All phrases are searched backwards at once, and occurrences are located by walking to the
next kept position. The hits of a document are merged into spans to remove.

Test items travel to the tasks in blocks of at most ``BLOCK_BYTES``, one pass over the documents for
each block, so what is broadcast does not grow with the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import saved, sliced, table

WINDOW = 10
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20
SAMPLE = 8
END, BREAK, FIRST_WORD = 0, 1, 2

# Words are runs of anything but [\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z: every other byte becomes a blank.
_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_WORD_BYTES = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions in suffix order, by prefix doubling."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key)
        new = np.zeros(n, np.int64)
        new[1:] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Access and rank over small numbers, one bit level after the other, for whole arrays of questions."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max()).bit_length())
        self.levels: list[tuple[np.ndarray, int]] = []   # ones before each position, number of zeros
        for level in reversed(range(self.bits)):
            ones = ((symbols >> level) & 1).astype(bool)
            before = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((before, len(symbols) - int(before[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        low, high = np.zeros_like(position), position
        for k, (before, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            low = np.where(one, zeros + before[low], low - before[low])
            high = np.where(one, zeros + before[high], high - before[high])
        return high - low

    def access(self, position: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(position)
        for before, zeros in self.levels:
            one = before[position + 1] > before[position]
            symbol = symbol * 2 + one
            position = np.where(one, zeros + before[position], position - before[position])
        return symbol


class FMIndex:
    """Backward search and sampled locating over a text of symbols that ends in its only END."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        order = suffix_array(symbols)
        self.wavelet = WaveletMatrix(symbols[order - 1])
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols))]).astype(np.int64)
        kept = order % sample == 0
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.kept = order[kept]

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of equally long phrases (one a row): the row range of each in suffix order."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.less[-1], np.int64)
        live = np.arange(len(phrases))
        for symbol in phrases.T[::-1]:
            known = symbol[live] < len(self.less) - 1
            high[live[~known]] = low[live[~known]]
            live = live[known]
            s = symbol[live]
            low[live] = self.less[s] + self.wavelet.rank(s, low[live])
            high[live] = self.less[s] + self.wavelet.rank(s, high[live])
            live = live[high[live] > low[live]]
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows in suffix order."""
        out, steps, left = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            here = rows[left]
            done = self.kept_before[here + 1] > self.kept_before[here]
            out[left[done]] = self.kept[self.kept_before[here[done]]] + steps
            left, here = left[~done], here[~done]
            symbol = self.wavelet.access(here)
            rows[left] = self.less[symbol] + self.wavelet.rank(symbol, here)
            steps += 1
        return out


class Phrases:
    """One block of test items: word numbers, distinct windows by length, and the items that have each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.number: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + FIRST_WORD) for w in words(text)]
            k = min(window, len(ids))
            for i in range(len(ids) - k + 1 if k else 0):
                by_length.setdefault(k, {}).setdefault(tuple(ids[i:i + k]), set()).add(item)
        self.groups = [(k, np.array(list(w), np.int64), [sorted(x) for x in w.values()]) for k, w in sorted(by_length.items())]
        self.shortest = min(by_length, default=0)


def shard_hits(texts: list[str | None], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], set]]:
    """For each text: number of words, merged spans of hit words (start, end), items that occur."""
    out: list[tuple[int, list, set]] = []
    numbers, lengths = [], []
    get = phrases.number.get
    for text in texts:
        own = words(text)
        lengths.append(len(own))
        numbers.append(np.fromiter((get(w, BREAK) for w in own), np.int32, len(own)))
        numbers.append(np.array([BREAK], np.int32))
        out.append((len(own), [], set()))
    if not phrases.groups or not texts:
        return out
    line = np.concatenate(numbers)
    first = np.cumsum([0] + [n + 1 for n in lengths])
    # runs of test words that are long enough, each followed by one break
    known = np.concatenate([[False], line >= FIRST_WORD, [False]])
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= phrases.shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return out
    sizes = ends - starts + 1
    at = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(at, sizes) + np.repeat(starts, sizes)   # position in `line`
    symbols = np.append(line[place].astype(np.int64), END)
    index = FMIndex(symbols)
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for g, (k, windows, _) in enumerate(phrases.groups):
        low, high = index.find(windows)
        count = high - low
        if not count.sum():
            continue
        which = np.repeat(np.arange(len(windows)), count)
        rows = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        where = place[index.locate(rows)]
        doc = np.searchsorted(first, where, side="right") - 1
        pairs = np.unique(doc * len(windows) + which)
        for p in pairs.tolist():
            out[p // len(windows)][2].update(phrases.groups[g][2][p % len(windows)])
        hits.append((doc, where - first[doc], np.full(len(doc), k)))
    if hits:
        doc, start, size = (np.concatenate(x) for x in zip(*hits))
        order = np.lexsort((start, doc))
        for d, a, k in zip(doc[order].tolist(), start[order].tolist(), size[order].tolist()):
            spans = out[d][1]
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], a + k))
            else:
                spans.append((a, a + k))
    return out


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "replace")
    at = [m.span() for m in _WORD.finditer(raw)]
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, clean: bool = False,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (word numbers, end excluded, disjoint, not touching) and ``hit_items`` (distinct ids
    as strings, sorted) to the documents; with ``clean`` also ``clean_text``, the text without its
    hit words.

    ``benchmark`` has item_id and text. A window is ``window`` consecutive words of an item; an item of fewer words is
    one window. Null and wordless texts have no words and no hits; a null item_id reads as the empty
    string; equal items are one. Without items nothing is hit. Columns of the documents
    stay as they are; those named like a new column are refused."""
    new = ["n_words", "hit_spans", "hit_items"] + ["clean_text"] * clean
    if clash := {c.lower() for c in new} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t")).where("t IS NOT NULL").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes) or 1
    out = docs.withColumns({"n_words": F.lit(0).cast("long"), "hit_spans": F.array().cast(SPANS), "hit_items": F.array().cast("array<string>")})
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()   # about block_bytes
        phrases = spark.sparkContext.broadcast(Phrases([(r.i, r.t) for r in rows], window))
        last = b == blocks - 1
        schema = T.StructType(out.schema.fields + [T.StructField("clean_text", T.StringType())] * (clean and last))
        out = out.mapInArrow(_searcher(phrases, text, clean and last), schema)
        if not last:
            out = saved(out, "decontaminate")
    return out


def _searcher(phrases, text: str, clean: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, SHARD_BYTES):
            texts = batch.column(text).to_pylist()
            found = shard_hits(texts, phrases.value)
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["n_words"] = pa.array([f[0] for f in found], pa.int64())
            if any(f[2] for f in found):
                old_spans, old_items = columns["hit_spans"].to_pylist(), columns["hit_items"].to_pylist()
                spans = [_merged([*((x["start"], x["end"]) for x in o), *f[1]]) if f[1] else [(x["start"], x["end"]) for x in o]
                         for o, f in zip(old_spans, found)]
                columns["hit_spans"] = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], columns["hit_spans"].type)
                columns["hit_items"] = pa.array([sorted({*o, *f[2]}) for o, f in zip(old_items, found)], columns["hit_items"].type)
            if clean:
                spans = [[(x["start"], x["end"]) for x in s] for s in columns["hit_spans"].to_pylist()]
                columns["clean_text"] = pa.array([without_words(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return run


def op10_decontamination(spark, sf_dir):
    """Hits of every benchmark window in every document."""
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


_SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_SQL_WORDS} AS w FROM benchmark),
bk AS (SELECT item_id, w, least(len(w), {WINDOW}) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS p
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
       FROM (SELECT r, w, k, unnest(range(1, greatest(len(w) - k, -1) + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM bw))),
h AS (SELECT r, k, i, item_id FROM dw JOIN bw USING (k, p)),
n AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""
