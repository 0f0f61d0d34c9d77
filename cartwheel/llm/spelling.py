"""Spelling variants: words one edit apart, each led to the most frequent of its variants.

Words are rows of padded code-point matrices. Two words are one inserted, deleted or replaced code point apart if their common
prefix and common suffix together reach the length of the longer one less one. Then one of the two, prefix or suffix, has at least half of that. So words are dealt to
groups by the first and by the last half, for their own length and for that of a word longer by one; every near pair meets
in the group of its prefix or else in that of its suffix, and is counted in one of them only. Groups are compared as
dense blocks of pairs; a group of more than ``TILE`` words is cut into parts, and each pair of parts is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import batch_of, drop_saved, saved, table

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_CHARS = 5
LEAST_COUNT = 3
RATIO = 2               # a form is at least so many times as frequent as its variant
TILE = 2048             # words of a part of a large group
TILE_CHARS = 1 << 22    # code points of a part, at most (or one word)
PAIR_CHARS = 1 << 22    # code points compared at once

_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def lowered(run: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of the runs of letters of whole texts; of every 97th run of a document one letter is deleted, by its checksum.
    Partial counts go through the shuffle, so a frequent word is one row of each task."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select(lowered(F.col("run")).alias("run"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (runs.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= LEAST_CHARS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT))


def half(size):
    """Of a pair whose longer word has this length, one of prefix and suffix has so many code points."""
    return size // 2


def tiles(words: DataFrame) -> DataFrame:
    """(size, side, key, i, j, part, word, n): the rows of each block of pairs; side 0 is by prefix, 1 by suffix."""
    sized = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size"))
    h = F.expr("size div 2").cast("int")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.xxhash64(F.lit(0), "size", F.substring("word", F.lit(1), h)).alias("key")),
                    F.struct(F.lit(1).alias("side"), F.xxhash64(F.lit(1), "size", F.substring("word", F.length("word") - h + 1, h)).alias("key")))
    rows = sized.select("word", "n", "size", F.inline(sides))
    large = (rows.groupBy("size", "side", "key").agg(F.count("*").alias("c"))
             .select("size", "side", "key", F.greatest(F.ceil(F.col("c") / TILE), F.ceil(F.col("c") * F.col("size") / TILE_CHARS)).cast("int").alias("parts"), "c")
             .where((F.col("c") > 1) & (F.col("parts") > 1)).drop("c"))
    rows = rows.join(large, ["size", "side", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("word", F.lit(11)), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select("size", "side", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "word", "n")


def _matrix(words: pa.Array, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word from the left, and from its end, padded with 0."""
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    flat = flat.astype(np.min_scalar_type(int(flat.max(initial=0))))
    left, right = np.zeros((len(sizes), width), flat.dtype), np.zeros((len(sizes), width), flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left[row, col] = flat
    right[row, np.repeat(sizes, sizes) - 1 - col] = flat
    return left, right


def _common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common start of rows of two matrices, ``most`` at most."""
    other = a != b
    first = other.argmax(axis=1)
    return np.minimum(np.where(other[np.arange(len(a)), first], first, a.shape[1]), most)


def _near(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Of complete blocks, all for one length: near words of each row, in its block."""
    width = t["size"][0].as_py()
    column = t["word"].combine_chunks()
    sizes = pc.utf8_length(column).to_numpy().astype(np.int64)
    side, key, lo, hi, part, n = (t[c].to_numpy() for c in ("side", "key", "i", "j", "part", "n"))
    left, right = _matrix(column, sizes, width)
    new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in (side, key, lo, hi)], axis=0)])
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(n)))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, PAIR_CHARS // width)
        keep = ((sizes[a] == width) | (sizes[b] == width)) & ((lo[a] == hi[a]) | (part[a] != part[b]))
        a, b = a[keep], b[keep]
        for k in range(0, len(a), step):
            x, y = a[k:k + step], b[k:k + step]
            most = np.minimum(sizes[x], sizes[y])
            prefix = _common(left[x], left[y], most)
            mine = np.where(side[x] == 0, prefix >= half(width), prefix < half(width))
            x, y, most, prefix = x[mine], y[mine], most[mine], prefix[mine]
            suffix = _common(right[x], right[y], most)
            ok = (prefix + suffix >= width - 1) & ((side[x] == 0) | (suffix >= half(width)))
            found.append((x[ok], y[ok]))

    small = np.repeat(count <= 32, count)
    block = np.cumsum(new)
    for lag in range(1, 32):            # small groups, all at once
        a = np.flatnonzero((block[lag:] == block[:-lag]) & small[lag:])
        if not len(a):
            break
        compare(a, a + lag)
    for s, c in zip(starts[count > 32].tolist(), count[count > 32].tolist()):
        rows = max(1, (1 << 20) // c)
        for k in range(0, c, rows):
            a, b = np.meshgrid(np.arange(s + k, s + min(c, k + rows)), np.arange(s + k, s + c), indexing="ij")
            ahead = b > a
            compare(a[ahead], b[ahead])
    if not found:
        return
    a = np.concatenate([x for x, _ in found] + [y for _, y in found])
    b = np.concatenate([y for _, y in found] + [x for x, _ in found])
    if not len(a):
        return
    order = np.empty(len(n), np.int64)
    order[pc.sort_indices(column).to_numpy()] = np.arange(len(n))
    at = np.lexsort((order[b], -n[b], a))
    a, b = a[at], b[at]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    yield batch_of(_FOUND, {"word": column.take(pa.array(a[first])), "n_near": np.diff(np.append(first, len(a))),
                            "best_n": n[b[first]], "best": column.take(pa.array(b[first]))})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words: how many, and the most frequent of them (ties: the
    smallest in code-point order)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            last = np.zeros(len(t), bool)
            for c in ("size", "side", "key", "i", "j"):
                own = t[c].to_numpy()
                last |= own != own[-1]
            other = np.flatnonzero(last)
            cut = int(other[-1]) + 1 if len(other) else 0
            rest = t.slice(cut)
            yield from by_size(t.slice(0, cut))
        if rest is not None:
            yield from by_size(rest)

    def by_size(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(t):
            return
        size = t["size"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], size[1:] != size[:-1]])).tolist()
        for s, e in zip(starts, [*starts[1:], len(size)]):
            yield from _near(t.slice(s, e - s).combine_chunks())

    blocks = tiles(words)
    order = ["size", "side", "key", "i", "j"]
    found = blocks.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "word string, n_near long, best_n long, best string")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to. Each step doubles the way that is known."""
    now = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = saved(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                      "spelling-roots")
        drop_saved(now)
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of words (word string, distinct; n long).

    Near words differ by exactly one inserted, deleted or replaced code point. The form of a word is the most frequent near
    word (ties: the smallest in code-point order) if that has at least twice its n; else null, as is form_n. The root
    is the last word that forms lead to, or the word itself. No near word: n_near 0. Null words are left out;
    other columns go; no rows give no rows."""
    words = saved(words.where("word IS NOT NULL").select("word", "n"), "spelling-words")
    near = near_words(words)
    formed = F.col("best_n") >= RATIO * F.col("n")
    out = saved(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "spelling-near")
    last = roots(out.where("form IS NOT NULL"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir):
    """Variants and roots of all words of the documents. A row without a doc_id has an empty identifier in the checksum."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents")))
