"""Toxicity by compression distance: which of two zstandard dictionaries makes a window of text shorter.

The ordinary dictionary is trained by zstandard on windows of ordinary documents. The toxic
dictionary is trained on toxic documents: the pieces of words that far more toxic than ordinary
documents have (counted by document, near copies once), in order of how often they occur, followed by the
ordinary dictionary's content at the same distances. So both shorten ordinary text equally, and a window gets
shorter under the toxic dictionary only where it has toxic material. Of a document count the largest
saving of a window, the sum, the number of windows that save and the number of windows. A logistic curve over these,
fitted to labelled rows that the dictionaries did not see, is the score.

(Dictionaries trained by zstandard alone on toxic and ordinary windows hardly tell them apart, as
toxic documents are mostly ordinary text: the area under the curve was 0.6 to 0.7 on held-out rows.)

Learning reads a bounded sample of labelled rows (``Bounds``); scoring reads every whole text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import drop_saved, saved, sliced, table

THRESHOLD = 0.3


@dataclass(frozen=True)
class Bounds:
    """What is learned from, at most. All rows are chosen by a hash of their id, whatever the table's size."""

    toxic_docs: int = 2000          # documents that the dictionaries are trained on
    ordinary_docs: int = 6000
    calibration_docs: int = 4000    # documents of other rows for the curve
    windows: int = 40_000           # windows of ordinary text for the dictionary
    dictionary_bytes: int = 100_000
    segments: int = 120             # pieces of toxic words kept
    grams: tuple[int, ...] = (5, 6, 7, 8)   # bytes of the grams that are counted
    min_share: float = 0.01         # of the toxic documents, that have a gram
    min_ratio: float = 10.0         # of the shares of toxic and ordinary documents that have it
    window_words: int = 16
    window_bytes: int = 400         # longer windows are not trained on (they are scored)
    level: int = 12
    held: int = 200_000             # counts that a task holds before it sends them on


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    bounds: Bounds
    weights: tuple[float, ...] = ()     # of the curve: the constant, then those of ``_curve``


def windows(text: str | None, size: int) -> list[bytes]:
    words = (text or "").lower().encode("utf-8", "replace").split()
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(0, len(words), size)]


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        compression_params=params)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.ordinary, self.toxic = (_compressor(d, model.bounds.level).compress for d in (model.ordinary, model.toxic))

    def savings(self, text: str | None) -> tuple[int, int, int, int]:
        """The largest saving of a window under the toxic dictionary in bytes (0 at least), the sum of the savings, how
        many windows save, and how many there are."""
        each = [len(self.ordinary(w)) - len(self.toxic(w)) for w in windows(text, self.model.bounds.window_words)]
        gains = [s for s in each if s > 0]
        return max(gains, default=0), sum(gains), len(gains), len(each)


# learning ----------------------------------------------------------------------------------------

def _labelled(labels: DataFrame, learn_from) -> DataFrame:
    """doc_id, toxic (0/1; the higher if labels disagree) of the labelled rows to learn from; null ids and labels are left out."""
    own = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    return own.where(learn_from).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _sample(labelled: DataFrame, bounds: Bounds, part) -> DataFrame:
    """At most the given numbers of rows by use: an id list of proven size."""
    def some(rows, n, use):
        return rows.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(n).withColumn("use", F.lit(use))
    train, rest = labelled.where(part), labelled.where(~part)
    return (some(train.where("toxic = 1"), bounds.toxic_docs, "train")
            .unionByName(some(train.where("toxic = 0"), bounds.ordinary_docs, "train"))
            .unionByName(some(rest, bounds.calibration_docs, "calibrate")))


def _grams(word: bytes, sizes: tuple[int, ...]) -> list[bytes]:
    return [word[i:i + n] for n in sizes for i in range(len(word) - n + 1)]


def _segments(word: bytes, chosen: set[bytes], sizes: tuple[int, ...]) -> list[bytes]:
    """The maximal parts of a word that are covered by chosen grams."""
    out: list[bytes] = []
    start = end = -1
    for i in range(len(word)):
        reach = max((i + n for n in sizes if i + n <= len(word) and word[i:i + n] in chosen), default=0)
        if reach:
            if i > end:
                if end > 0:
                    out.append(word[start:end])
                start = i
            end = max(end, reach)
    return out + ([word[start:end]] if end > 0 else [])


def _words(text: str | None, limit: int) -> list[bytes]:
    return [b" " + w + b" " for w in (text or "").lower().encode("utf-8", "replace").split() if len(w) <= limit]


def _kin(text: str | None) -> int:
    """A minhash of the three-word shingles: equal for near copies, as a rule, and for hardly any others."""
    words = (text or "").lower().encode("utf-8", "replace").split()
    return min((xxhash.xxh3_64_intdigest(b" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))), default=0) - (1 << 63)


def _counted(batches: Iterator[pa.RecordBatch], items_of, name: str, held: int) -> Iterator[pa.RecordBatch]:
    """(toxic, item, n) of the items of each text; sent on whenever more than ``held`` are counted, so a task's memory doesn't grow with its rows."""
    def counts() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in own], pa.int32()), pa.array([k[1] for k in own], pa.binary()),
                                           pa.array(list(own.values()), pa.int64())], names=["toxic", name, "n"])
    own: Counter = Counter()
    for batch in sliced(batches, "text"):
        for t, x in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own.update(items_of(t, x))
            if len(own) > held:
                yield counts()
                own.clear()
    yield counts()


def train(docs: DataFrame, labels: DataFrame, learn_from=None, bounds: Bounds = Bounds(), text: str = "text") -> Model:
    """Dictionaries and curve from the labelled rows that meet ``learn_from`` (a condition on
    doc_id; default all). Half of the ids train the dictionaries, the others fit the curve.
    Without both toxic and ordinary rows among the others, every score is the share of toxic rows there
    (0 if there are none)."""
    labelled = _labelled(labels, F.lit(True) if learn_from is None else learn_from)
    chosen = _sample(labelled, bounds, F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    rows = saved(docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id"), "toxicity-sample")

    def kin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            own = pa.array([_kin(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "kin"])

    distinct = saved(rows.where("use = 'train'").select("text", "toxic").mapInArrow(kin, "text string, toxic int, kin long")
                     .groupBy("kin").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")), "toxicity-distinct")
    n = {r.toxic: r.n for r in distinct.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, lambda t, x: {(x, g) for w in set(_words(t, bounds.window_bytes)) for g in _grams(w, bounds.grams)}, "gram", bounds.held)

    least = max(3, math.ceil(bounds.min_share * n.get(1, 0)))
    share = (F.col("n1") / max(1, n.get(1, 0))) / ((F.col("n0") + 1) / max(1, n.get(0, 0)))
    found = (distinct.mapInArrow(grams, "toxic int, gram binary, n long").groupBy("gram")
             .agg(F.sum(F.col("toxic") * F.col("n")).alias("n1"), F.sum((1 - F.col("toxic")) * F.col("n")).alias("n0"))
             .where((F.col("n1") >= least) & (share >= bounds.min_ratio))
             .orderBy(F.desc("n1"), "gram").limit(40 * bounds.segments).collect()) if n.get(0) and n.get(1) else []
    frequent = {bytes(r.gram) for r in found}

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, lambda t, x: ((x, s) for w in _words(t, bounds.window_bytes) for s in _segments(w, frequent, bounds.grams)), "segment", bounds.held)

    top = (distinct.where("toxic = 1").mapInArrow(segments, "toxic int, segment binary, n long").groupBy("segment").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "segment").limit(bounds.segments).collect()) if frequent else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            own = [w for t in batch.column("text").to_pylist() for w in windows(t, bounds.window_words) if len(w) <= bounds.window_bytes]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], names=["w"])

    ordinary = [bytes(r.w) for r in distinct.where("toxic = 0").mapInArrow(cut, "w binary").distinct()
                .orderBy(F.xxhash64("w"), "w").limit(bounds.windows).collect()]
    try:
        base = zstandard.train_dictionary(bounds.dictionary_bytes, ordinary, k=48, d=6).as_bytes()
    except zstandard.ZstdError:      # too few samples to train on
        base = b"".join(ordinary)[-bounds.dictionary_bytes:]
    model = Model(base, b"".join(bytes(r.segment) for r in reversed(top)) + base, bounds)
    seen = with_savings(rows.where("use = 'calibrate'"), model).select(*_curve(), "toxic").collect()     # at most calibration_docs
    drop_saved(rows)
    drop_saved(distinct)
    return replace(model, weights=_fitted(np.array([r[:-1] for r in seen], float), np.array([r[-1] for r in seen], float)))


def _curve() -> list:
    """What the curve is over, as columns of the output of ``with_savings``."""
    margin, saving, hits, n = (F.col(c).cast("double") for c in ("margin", "saving", "n_saving", "n_windows"))
    return [F.least(margin, F.lit(6.0)), (margin > 0).cast("double"), F.log1p(hits), F.log1p(saving), saving / F.greatest(n, F.lit(1.0)), F.log1p(n)]


def _fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Weights of a logistic curve, the constant first, by Newton steps. An infinite constant alone if all labels are equal."""
    if not len(y) or y.min() == y.max():
        return (math.inf if len(y) and y[0] else -math.inf,)
    z = np.column_stack([np.ones(len(y)), x])
    b = np.zeros(z.shape[1])
    penalty = np.r_[1e-6, np.full(len(b) - 1, ridge)]
    for _ in range(40):
        q = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + np.diag(penalty), z.T @ (y - q) - penalty * b)
        b = b + step
        if abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in b)


# scoring -----------------------------------------------------------------------------------------

_SAVINGS = [T.StructField("margin", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("saving", "n_saving", "n_windows")]]


def with_savings(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add margin, saving, n_saving and n_windows (see ``Scorer.savings``) to each row. Null, empty and blank texts have 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # a few hundred kB by its bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in sliced(batches, text):
            found = [scorer.savings(t) for t in batch.column(text).to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.int64() if k else pa.int32()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *(f.name for f in _SAVINGS)])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + _SAVINGS))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: toxic likelier) and the margin, saving, n_saving and n_windows it comes from.

    Only the text is looked at, all of it. Null, empty and blank texts have no windows and one score. Repeated
    rows score alike; no rows give no rows. Other columns stay; clashing names are refused."""
    new = {"score", *(f.name for f in _SAVINGS)}
    if clash := new & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    constant, *slopes = model.weights or (-math.inf,)
    if math.isinf(constant):
        return with_savings(docs, model, text).withColumn("score", F.lit(float(constant > 0)))
    total = sum((w * c for w, c in zip(slopes, _curve())), F.lit(constant))
    return with_savings(docs, model, text).withColumn("score", 1 / (1 + F.exp(-F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0)))))


def fold_of(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4


def op2_toxicity(spark, sf_dir):
    """Scores of all documents; rows with crc32(doc_id) mod 4 = 2 are never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), fold_of() != 2)
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(fold_of() == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "margin", "saving", "n_saving", "n_windows")
