"""Repeated substrings by longest-previous-factor arrays.

For a text, LPF[i] is the length of the longest string that starts at i and also starts earlier. In
suffix order it comes from the two nearest suffixes with a smaller position, before and after i: the
larger of their common prefixes with i. With positions counted from the end the same gives the
longest string that starts later.

The corpus cannot be one suffix array, so strings that may be equal are first brought together. Every
window of ``length`` bytes is dealt to its anchor, the k-gram in it with the smallest hash; equal windows
have equal anchors. Neighbouring windows share one (about 70 of them), so a document is a list of anchors with the
slice of text that holds their windows. Anchors that occur once anywhere are done. Slices that are equal as a whole
repeat as a whole. Of what is left, one copy of each slice goes to the task of its anchor, which
builds the suffix array of its slices and the LPF arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.chunks import cut_out
from cartwheel.llm.common import GOLDEN, batch_of, bytes_of, mixed, prefix_hashes, saved, sliced, span_hashes, table

LENGTH = 200
GRAM = 64
PIECE_BYTES = 4 << 20       # of one long text handled at once; positions take 24 bits below
CLASS_SLICES = 2000         # anchors with more different slices are settled by hashes, not in one task
GROUP = 8                   # neighbouring windows that are hashed together then
SUFFIX_BYTES = 1 << 20      # text of one suffix array
_POS = np.uint64(24)


# suffix order ------------------------------------------------------------------------------------

def prefix_ranks(text: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, .. bytes, up to the largest power of two within ``depth`` (8 at least).
    ``text`` holds small numbers; past its end stands a number smaller than all."""
    n = len(text)
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)])
    width = np.uint64(int(padded.max()).bit_length())
    if int(width) * 4 > 63:
        raise ValueError("symbols are too large")
    per = min(8, 63 // int(width))
    for i in range(per):
        key = (key << width) | padded[i:i + n]
    out = [np.unique(key, return_inverse=True)[1]]
    size = per
    while size * 2 <= depth:
        out.append(_joined(out[-1], size))
        size *= 2
    return out


def _joined(rank: np.ndarray, size: int) -> np.ndarray:
    n = len(rank)
    key = rank.astype(np.int64) * (n + 1)
    key[:n - size] += rank[size:] + 1
    return np.unique(key, return_inverse=True)[1]


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left of each, or -1. All at once: whoever is not smaller hands on to its own."""
    out = np.arange(-1, len(values) - 1)
    left = np.flatnonzero(out >= 0)
    while len(left):
        left = left[values[out[left]] >= values[left]]
        out[left] = out[out[left]]
        left = left[out[left] >= 0]
    return out


def common_prefix(ranks: list[np.ndarray], unit: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes i and j (-1: none), in steps of ``unit`` symbols, as far as the ranks reach."""
    n = len(ranks[0])
    out = np.zeros(len(i), np.int64)
    live = j >= 0
    for level in reversed(range(len(ranks))):
        size = unit << level
        a, b = i + out, j + out
        same = live & (a < n) & (b < n)
        same[same] = ranks[level][a[same]] == ranks[level][b[same]]
        out[same] += size
    return out


def repeated_windows(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start: is LPF at least ``length`` (the window also starts at an earlier one of ``starts``),
    and does it also start at a later one.

    The suffixes at ``starts`` are ordered by their first ``length`` symbols. The nearest smaller positions on both
    sides give the earlier match; with positions turned round they give the later match."""
    ranks = prefix_ranks(text, length)
    width = int((int(text.max()) + 1).bit_length())
    unit = min(8, 63 // width)
    size = unit << (len(ranks) - 1)
    top, n = ranks[-1], len(text)
    # the ranks of the first `length` symbols: two overlapping windows of `size`, and one more if they do not reach
    parts = [top[starts]] + [top[np.minimum(starts + s, n - 1)] for s in range(size, length - size, size)] + [top[np.minimum(starts + length - size, n - 1)]]
    order = np.lexsort(tuple(reversed(parts)))
    same = np.ones(len(order), bool)     # equal to the one before in suffix order, over the whole length
    same[0] = False
    for p in parts:
        same[1:] &= p[order[1:]] == p[order[:-1]]
    run = np.cumsum(~same)
    position = starts[order]

    def has_smaller(where: np.ndarray) -> np.ndarray:
        before = nearest_smaller(where)
        after = len(where) - 1 - nearest_smaller(where[::-1])[::-1]
        found = (before >= 0) & (run[before] == run)
        return found | ((after < len(where)) & (run[np.minimum(after, len(where) - 1)] == run))

    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    earlier[order] = has_smaller(position)
    later[order] = has_smaller(-position)
    return earlier, later


def lpf(text: np.ndarray, length: int) -> np.ndarray:
    """The LPF array of a text of small numbers, exact up to ``length`` and cut off there; the plain form of what ``repeated_windows`` asks."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    ranks = [np.unique(text, return_inverse=True)[1]]
    while (1 << len(ranks)) <= length:
        ranks.append(_joined(ranks[-1], 1 << (len(ranks) - 1)))
    order = np.lexsort((np.arange(n), ranks[-1]))
    before = nearest_smaller(order)
    after = len(order) - 1 - nearest_smaller(order[::-1])[::-1]
    both = [np.where((k >= 0) & (k < n), order[np.clip(k, 0, n - 1)], -1) for k in (before, after)]
    out = np.zeros(n, np.int64)
    out[order] = np.maximum(*[common_prefix(ranks, 1, order, b) for b in both])
    return np.minimum(out, length)


# anchors -----------------------------------------------------------------------------------------

def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Of texts one after the other: for each anchor its text (``doc``), the first of its windows in the
    text (``start``), how many windows (``n``), where in the slice the anchor is (``at``), and hashes of the
    anchor (``a``) and the slice (``s``)."""
    n, reach = len(data), length - gram + 1
    if n < length:
        return {k: np.zeros(0, np.int64) for k in ("doc", "start", "n", "at", "a", "s")}
    prefix = prefix_hashes(data)
    places = np.arange(n - gram + 1)
    hashes = span_hashes(prefix, places, places + gram)
    least = (hashes >> _POS << _POS) | places.astype(np.uint64)     # ties: the leftmost
    size = 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[:len(least) - (reach - size)], least[reach - size:])
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(least)]
    x = np.flatnonzero(np.arange(len(least)) + length <= offsets[doc + 1])
    if not len(x):
        return {k: np.zeros(0, np.int64) for k in ("doc", "start", "n", "at", "a", "s")}
    anchor = (least[x] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.ones(len(x), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (x[1:] != x[:-1] + 1) | (doc[x[1:]] != doc[x[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(x)) - 1
    start, end, p = x[first], x[last] + length, anchor[first]
    own = doc[start]
    return {"doc": own, "start": start - offsets[own], "n": last - first + 1, "at": p - start, "a": hashes[p].view(np.int64),
            "s": mixed(span_hashes(prefix, start, end) + (p - start + 1).astype(np.uint64) * GOLDEN).view(np.int64)}


_ANCHOR = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("at", pa.int32()),
                     ("a", pa.int64()), ("s", pa.int64())])


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each anchor of (doc_id, _h, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            data, offsets = bytes_of(batch.column("text"))
            # a long text in pieces that share length - 1 bytes, so that each window is in one piece
            step = PIECE_BYTES if len(offsets) == 2 else len(data)
            for begin in range(0, max(len(data), 1), max(step, 1)):
                part = data[begin:begin + step + length - 1]
                found = anchors(part, offsets if step == len(data) else np.array([0, len(part)]), length, gram)
                row = pa.array(found["doc"])
                yield batch_of(_ANCHOR, {"doc_id": batch.column("doc_id").take(row), "_h": batch.column("_h").take(row),
                                         "start": found["start"] + begin, **{k: found[k] for k in ("n", "at", "a", "s")}})

    return docs.select("doc_id", "_h", "text").mapInArrow(run, "doc_id long, _h long, start int, n int, at int, a long, s long")


def packed(docs: DataFrame) -> DataFrame:
    """The documents with their texts compressed, for a shuffle of less than half the bytes."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_h"),
                                              pa.array([pack((t or "").encode("utf-8", "replace")) for t in batch.column("text").to_pylist()], pa.binary())],
                                             names=["doc_id", "_h", "z"])

    return docs.select("doc_id", "_h", "text").mapInArrow(run, "doc_id long, _h long, z binary")


_SLICE = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("at", pa.int32()), ("a", pa.int64()),
                    ("many", pa.bool_()), ("slice", pa.binary())])


def slices(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted slices: wanted has doc_id, _h and an array ``own`` of struct<start, n, at, a, many>."""
    joined = packed(docs).join(wanted.withColumnsRenamed({"doc_id": "_id", "_h": "_k"}),
                               F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_k"))).select("doc_id", "_h", "z", "own")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in sliced(batches, "z", 1 << 18):
            out: dict[str, list] = {f.name: [] for f in _SLICE}
            seen = set()
            for d, h, z, own in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "_h", "z", "own")]):
                if (d, h) in seen:      # a row that repeats in doc_id and text
                    continue
                seen.add((d, h))
                text = unpack(z)
                for x in own:
                    for k, v in (("doc_id", d), ("_h", h), ("start", x["start"]), ("n", x["n"]), ("at", x["at"]), ("a", x["a"]), ("many", x["many"]),
                                 ("slice", text[x["start"]:x["start"] + x["n"] - 1 + length])):
                        out[k].append(v)
            yield batch_of(_SLICE, out)

    return joined.mapInArrow(run, "doc_id long, _h long, start int, n int, at int, a long, many boolean, slice binary")


_SPAN = "doc_id long, _h long, start int, end int"


def _spans(flags: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of flagged windows (flags of all slices one after the other): slice, first byte, end."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    x = np.arange(len(flags)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (which[at[1:]] != which[at[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return which[at[first]], x[at[first]], x[at[last]] + length


def class_spans(rows: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """Repeated spans among the different slices of each anchor. Rows come sorted by anchor and position;
    anchors are taken together up to ``SUFFIX_BYTES``, as windows of different anchors are never equal."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for part in sliced([batch], "slice", SUFFIX_BYTES):
                t = pa.Table.from_batches([part])
                bytes_in = len(bytes_of(part.column("slice"))[0])
                if held and size + bytes_in > SUFFIX_BYTES:
                    # what is complete: all rows before the last anchor
                    whole = pa.concat_tables(held).combine_chunks()
                    a = whole["a"].to_numpy()
                    cut = int(np.searchsorted(a, a[-1]))
                    if cut:
                        yield from settle(whole.slice(0, cut))
                        held = [whole.slice(cut)]
                        size = int(sum(map(len, held[0]["slice"].to_pylist())))
                held.append(t)
                size += bytes_in
        if held:
            yield from settle(pa.concat_tables(held).combine_chunks())

    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        data, offsets = bytes_of(t["slice"].combine_chunks())
        sizes, starts = t["n"].to_numpy().astype(np.int64), t["start"].to_numpy().astype(np.int64)
        x = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(offsets[:-1], sizes)
        earlier, later = repeated_windows(data, x, length)
        which, a, b = _spans(earlier if keep_first else earlier | later, starts, sizes, length)
        ids = pa.array(which)
        yield pa.RecordBatch.from_arrays([t["doc_id"].combine_chunks().take(ids), t["_h"].combine_chunks().take(ids),
                                          pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["doc_id", "_h", "start", "end"])

    return rows.mapInArrow(run, _SPAN)


_WINDOW = pa.struct([("start", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])


def window_groups(rows: DataFrame, length: int) -> DataFrame:
    """Up to ``GROUP`` neighbouring windows of a slice, those at the same distances from the anchor: ``c``, a hash of the anchor
    and of the bytes that all windows at these distances have in common, ``f``, a hash of all their bytes, and two
    hashes of each window. Equal windows are in groups of equal ``c``; groups of equal ``f`` are equal."""
    schema = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("c", pa.int64()),
                        ("f", pa.int64()), ("windows", pa.list_(_WINDOW))])

    def run(batches):
        for batch in sliced(batches, "slice", 1 << 18):
            data, offsets = bytes_of(batch.column("slice"))
            n, at, start = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "at", "start"))
            row = np.repeat(np.arange(len(n)), n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x = inside + offsets[row]
            prefix, half = prefix_hashes(data), length // 2
            w1, w2 = span_hashes(prefix, x, x + half), span_hashes(prefix, x + half, x + length)
            distance = at[row] - inside                 # from the window's start to the anchor
            block = distance // GROUP
            new = np.ones(len(x), bool)
            new[1:] = (row[1:] != row[:-1]) | (block[1:] != block[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(x)) - 1
            anchor = offsets[row[first]] + at[row[first]]
            # what windows at distances block * GROUP .. + GROUP - 1 share: from the nearest start to the earliest end
            c = span_hashes(prefix, anchor - block[first] * GROUP, anchor - block[first] * GROUP - (GROUP - 1) + length)
            c = mixed(c ^ mixed(batch.column("a").to_numpy().view(np.uint64)[row[first]] + block[first].astype(np.uint64) * GOLDEN))
            f = mixed(span_hashes(prefix, x[first], x[last] + length) + distance[first].astype(np.uint64) * GOLDEN)
            windows = pa.StructArray.from_arrays([pa.array(inside + start[row], pa.int32()), pa.array(w1.view(np.int64)),
                                                  pa.array(w2.view(np.int64))], fields=list(_WINDOW))
            ids = pa.array(row[first])
            yield batch_of(schema, {"doc_id": batch.column("doc_id").take(ids), "_h": batch.column("_h").take(ids),
                                    "start": (inside + start[row])[first], "n": last - first + 1, "c": c.view(np.int64), "f": f.view(np.int64),
                                    "windows": pa.ListArray.from_arrays(pa.array(np.append(first, len(x)), pa.int32()), windows)})

    return rows.mapInArrow(run, "doc_id long, _h long, start int, n int, c long, f long, windows array<struct<start int, w1 long, w2 long>>")


def _kinds(rows: DataFrame, group: str, content: str, *more: str) -> DataFrame:
    """One row for each content of a group: the first place that has it, and how many do."""
    return (rows.groupBy(group, content)
            .agg(F.min(F.struct("doc_id", "_h", "start", "n", *more)).alias("first"), F.count("*").alias("copies")))


def _copied(rows: DataFrame, kinds: DataFrame, group: str, content: str, length: int, keep_first: bool) -> DataFrame:
    """Spans of rows whose content occurs again as a whole (with ``keep_first``: but for the first)."""
    out = rows.join(kinds.where("copies > 1").select(group, content, F.col("first").alias("_f")), [group, content])
    if keep_first:
        out = out.where(~F.struct("doc_id", "_h", "start").eqNullSafe(F.struct("_f.doc_id", "_f._h", "_f.start")))
    return out.select("doc_id", "_h", "start", (F.col("start") + F.col("n") - 1 + length).alias("end"))


def _different(kinds: DataFrame, group: str, keep_first: bool) -> DataFrame:
    """Groups with different contents, of which one at least may still hold something new."""
    return (kinds.groupBy(group).agg(F.count("*").alias("slices"), F.sum((F.col("copies") == 1).cast("long")).alias("open"))
            .where(F.col("slices") > 1).where(F.lit(True) if keep_first else F.col("open") > 0))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = False,
                   class_slices: int = CLASS_SLICES) -> DataFrame:
    """Byte spans of documents (doc_id, _h, text) covered by a string of ``length`` bytes that starts
    elsewhere too (``keep_first``: that starts earlier, in the order of doc_id and position). One row
    for each document that has any, ``spans`` in no order and with overlaps."""
    every = anchor_rows(docs, length, gram)
    often = every.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    some = saved(every.join(often, "a"), "anchors")
    kinds = saved(_kinds(some, "a", "s", "at"), "anchor-slices")
    whole = _copied(some, kinds, "a", "s", length, keep_first)
    wanted = (kinds.join(_different(kinds, "a", keep_first), "a").select("first.*", "a", (F.col("slices") > class_slices).alias("many"))
              .groupBy("doc_id", "_h").agg(F.collect_list(F.struct("start", "n", "at", "a", "many")).alias("own")))
    cut = saved(slices(docs, wanted, length), "slices")
    few = class_spans(cut.where(~F.col("many")).repartition("a").sortWithinPartitions("a", "doc_id", "_h", "start"), length, keep_first)
    # anchors with very many slices: the same steps once more, on groups of windows and then on windows
    groups = window_groups(cut.where("many"), length)
    parts = saved(_kinds(groups, "c", "f", "windows"), "window-groups")
    many = _copied(groups, parts, "c", "f", length, keep_first)
    windows = (parts.join(_different(parts, "c", keep_first), "c").select("first.doc_id", "first._h", F.inline("first.windows")))
    spot = F.struct("doc_id", "_h", "start")
    again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(spot).alias("first")).where("n > 1").drop("n")
    single = windows.join(again, ["w1", "w2"])
    if keep_first:
        single = single.where(~spot.eqNullSafe(F.col("first")))
    single = single.select("doc_id", "_h", "start", (F.col("start") + length).alias("end"))
    return (whole.unionByName(few).unionByName(many).unionByName(single).groupBy("doc_id", "_h")
            .agg(F.collect_set(F.struct("start", "end")).alias("spans")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = True) -> DataFrame:
    """Documents (doc_id long, text) without repeated strings of ``length`` bytes or more: doc_id, text, n_bytes,
    n_removed, n_spans (maximal runs taken out) and kept (the bytes left; a cut may divide a character).

    Texts are judged as they come, as UTF-8, each by itself; matches may overlap and may be in one
    document. With ``keep_first`` the first copy in the order of doc_id (null first) and position stays, else no
    copy does. Rows that are equal in doc_id and text are copies of each other, share one result, and
    with ``keep_first`` count as first together. Null is empty; texts shorter than ``length`` stay as
    they are; no rows give no rows. Other columns are not carried."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    return cut_out(docs, repeated_spans(docs, length, keep_first=keep_first))


def op7_suffix_repeats(spark, sf_dir):
    """Every byte covered by a 200-byte string that starts anywhere else too is removed."""
    out = remove_repeats(table(spark, sf_dir, "documents"), keep_first=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
