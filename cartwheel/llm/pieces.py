"""N-best encoding and decoding with a SentencePiece vocabulary.

The pieces that match a text form a lattice; a segmentation is a path through it and its score the
sum of its pieces' scores. A forward Viterbi pass gives the best score of every prefix. A search from
the end backwards then uses these as the cost still to come: they are exact, so A-star returns whole
paths in order of their score and never opens one that is not among the N best. Paths share the part they
have in common, so a unit of any length fits.

No piece reaches over certain places (before a space mark that follows another character, and around
characters that no longer piece has), so the lattice falls apart into units. The Viterbi scores
of a text are sums over its units, so the same search over units only has to know by how much each
unit's next best segmentation is worse: the N best of a text change at most N - 1 units, those with
the smallest gaps. Units repeat a lot, so each task keeps those it has seen.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import GOLDEN, sliced, table

N_BEST = 4
MARK = "▁"
UNKNOWN_PENALTY = 10.0      # an unknown character scores this much less than the worst piece
KNOWN_UNITS = 120_000       # units that a task remembers before it starts anew ..
KNOWN_CHARS = 2 << 20       # .. and their characters
BATCH_BYTES = 1 << 20       # text whose new units are searched together
UNIT_CHARS = 32             # longer units are searched one by one
NORMAL, UNKNOWN, BYTE, USER = 1, 2, 6, 4
INF = float("inf")


def default_model() -> str:
    """The public 32k vocabulary of the box; any other .model file may be given instead."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with ids and scores, read from a serialized .model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only vocabularies with identity normalization are supported")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        pieces = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER)}
        self.setup(pieces, [p.piece for p in proto.pieces],
                   {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE},
                   next((i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN), 0))

    @classmethod
    def of(cls, pieces: dict[str, float], prefix: str = "") -> "Vocabulary":
        """A small vocabulary for tests: id 0 is the unknown piece, without bytes."""
        self = cls.__new__(cls)
        self.prefix = prefix
        self.setup({p: (i, s) for i, (p, s) in enumerate(pieces.items(), 1)}, ["", *pieces], {}, 0)
        return self

    def setup(self, pieces, names, byte_ids, unknown):
        self.pieces, self.byte_ids, self.unknown = pieces, byte_ids, unknown
        self.longest = max(map(len, pieces), default=1)
        self.unknown_score = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        values = {i: bytes([b]) for b, i in byte_ids.items()}
        self.bytes = [values.get(i) or (n.replace(MARK, " ").encode() if n in pieces else b"\xef\xbf\xbd" * (i == unknown))
                      for i, n in enumerate(names)]
        self.lookup = _Lookup(pieces)
        joined = {c for p in pieces if len(p) > 1 for c in p}
        runs = "".join(re.escape(c) for c in sorted(joined - {MARK}))
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        run = f"[{runs}{MARK}]+" if crossing else f"{MARK}*[{runs}]+|{MARK}+" if runs else f"{MARK}+"
        self.units = re.compile(f"{run}|.", re.DOTALL).findall

    def edges(self, unit: str, j: int) -> Iterator[tuple[int, int, float]]:
        """(start, edge, score) of the pieces that end at a place. An edge is the id of its piece, or -1 - start for a character that is none."""
        for i in range(max(0, j - self.longest), j):
            hit = self.pieces.get(unit[i:j])
            if hit is not None:
                yield i, hit[0], hit[1]
            elif i == j - 1:
                yield i, -j, self.unknown_score

    def ids_of(self, unit: str, edge: int) -> tuple[int, ...]:
        if edge >= 0:
            return (edge,)
        return tuple(self.byte_ids[b] for b in unit[-1 - edge].encode("utf-8", "replace")) if self.byte_ids else (self.unknown,)

    def n_best(self, unit: str, n: int) -> list[tuple[float, tuple]]:
        """The n best (score, ids) of a unit; equal scores in the order of their ids read from the end.

        An open path stands for all segmentations that end with it, and costs what the best of them does. No two
        share one, so of the open paths only as many as results are still missing can lead to one, and the others
        go: memory grows with the length of the unit alone."""
        ahead = array("d", [0.0])       # best score of each prefix
        for j in range(1, len(unit) + 1):
            ahead.append(max([ahead[i] + s for i, _, s in self.edges(unit, j)], default=-INF))
        paths = _Paths(lambda edge: self.ids_of(unit, edge)[::-1])
        opened: list[tuple[float, int, int, int, float]] = []       # cost, path, one more edge, place, score; best first
        found: list[tuple[float, tuple]] = []
        path, j, score = 0, len(unit), 0.0
        while True:
            if j == 0:
                found.append((score, tuple(chain.from_iterable(self.ids_of(unit, e) for e in paths.edges(path)))))
            else:
                for i, edge, s in self.edges(unit, j):
                    cost, at = -(ahead[i] + score + s), len(opened)
                    while at and (cost < opened[at - 1][0] or cost == opened[at - 1][0] and paths.before(path, edge, *opened[at - 1][1:3])):
                        at -= 1
                    if at < n - len(found):
                        opened.insert(at, (cost, path, edge, i, score + s))
                        del opened[n - len(found):]
            if len(found) == n or not opened:
                return found
            _, path, edge, j, score = opened.pop(0)
            path = paths.add(path, edge)

    def first_two(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For many units of one length at once: ids of the best, one unit after the other, how many, their score, and how
        much worse the second best is (infinite if there is none). The search of ``n_best``, as far
        as its second result: that leaves the best path at one place, walking back, by an edge that is not the
        best there, and takes the Viterbi path from it."""
        n, count = len(units[0]), len(units)
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(count, n)
        ahead, hashes = np.zeros((n + 1, count)), []
        gap, came, used = (np.zeros((n + 1, count), t) for t in (np.float64, np.int8, np.int32))
        for j in range(1, n + 1):
            best, second = np.full(count, -INF), np.full(count, -INF)
            hashes.append(np.zeros(count, np.uint64))
            for i in range(max(0, j - self.longest), j):
                hashes[i] = _Lookup.further(hashes[i], chars[:, j - 1])
                ids, scores = self.lookup(hashes[i], j - i)
                if i == j - 1:      # a character that is no piece: its bytes
                    scores = np.where(ids < 0, self.unknown_score, scores)
                total = ahead[i] + scores
                # equal scores: the smaller id first
                better = (total > best) | ((total == best) & (total > -INF) & (ids < used[j]))
                second = np.maximum(second, np.minimum(best, total))
                best = np.maximum(best, total)
                came[j] = np.where(better, i, came[j])
                used[j] = np.where(better, ids, used[j])
            ahead[j], gap[j] = best, best - second
        at, least, every = np.full(count, n), np.full(count, INF), np.arange(count)
        steps = []
        while True:
            live = at > 0
            if not live.any():
                break
            least = np.where(live, np.minimum(least, gap[at, every]), least)
            steps.append(np.where(live, used[at, every], -2))
            at = np.where(live, came[at, every], 0)
        path = np.stack(steps[::-1], axis=1).astype(np.int32)       # -2: no step, -1: an unknown character
        sizes, flat = (path >= 0).sum(axis=1), path[path >= 0]
        unknown = np.flatnonzero((path == -1).any(axis=1))
        if len(unknown):
            cuts = np.split(flat, np.cumsum(sizes)[:-1])
            for k in unknown.tolist():
                cuts[k] = self.slowly(units[k])[0]
                sizes[k] = len(cuts[k])
            flat = np.concatenate(cuts)
        return flat, sizes, ahead[n], least

    def slowly(self, unit: str) -> tuple[np.ndarray, int, float, float]:
        """The same for one unit."""
        best = self.n_best(unit, 2)
        return np.array(best[0][1], np.int32), len(best[0][1]), best[0][0], best[0][0] - best[1][0] if len(best) > 1 else INF

    def decode(self, ids) -> str:
        raw = b"".join([self.bytes[i] for i in ids])
        return raw[len(self.prefix and b" "):].decode("utf-8", "replace")


class _Paths:
    """Paths through a lattice, read from the end: each is a shorter one, its parent, and one more edge. Path 0 is
    empty. A second link jumps over many parents, so two paths find where they part in few steps."""

    def __init__(self, ids_of):
        self.ids_of = ids_of        # of an edge, in the order in which they are compared
        self.parent, self.edge, self.depth, self.jump = array("i", [0]), array("i", [0]), array("i", [0]), array("i", [0])

    def add(self, path: int, edge: int) -> int:
        far = self.jump[path]
        even = self.depth[path] - self.depth[far] == self.depth[far] - self.depth[self.jump[far]]
        self.jump.append(self.jump[far] if even else path)
        self.parent.append(path)
        self.edge.append(edge)
        self.depth.append(self.depth[path] + 1)
        return len(self.parent) - 1

    def edges(self, path: int) -> Iterator[int]:
        """The edge that was added last comes first."""
        while path:
            yield self.edge[path]
            path = self.parent[path]

    def _up(self, path: int, edge: int, depth: int) -> tuple[int, int]:
        """The start of that depth of a path and one more edge, and the edge after it."""
        if self.depth[path] == depth:
            return path, edge
        while self.depth[path] > depth + 1:
            far = self.jump[path]
            path = far if self.depth[far] > depth else self.parent[path]
        return self.parent[path], self.edge[path]

    def before(self, x: int, x_edge: int, y: int, y_edge: int) -> bool:
        """Whether the ids of path x and one more edge come before those of y and one more; neither is the start of the other."""
        depth = min(self.depth[x], self.depth[y])
        (x, x_edge), (y, y_edge) = self._up(x, x_edge, depth), self._up(y, y_edge, depth)
        while x != y:
            if self.jump[x] != self.jump[y]:
                x, y = self.jump[x], self.jump[y]
            else:
                x, x_edge, y, y_edge = self.parent[x], self.edge[x], self.parent[y], self.edge[y]
        return self.ids_of(x_edge) < self.ids_of(y_edge)


class _Lookup:
    """Ids and scores of many strings of one length at once: a hash table in arrays."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        self.by_length: dict[int, tuple] = {}
        lengths: dict[int, list[str]] = {}
        for p in pieces:
            lengths.setdefault(len(p), []).append(p)
        for n, own in lengths.items():
            bits = max(4, (8 * len(own)).bit_length())
            chars = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), n)
            hashes = self.hashed(chars)
            table, values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            mask = (1 << bits) - 1
            for h, piece in zip(hashes.tolist(), own):
                slot = h & mask
                while values[slot] >= 0:
                    if int(table[slot]) == h:
                        raise ValueError("two pieces with one hash")
                    slot = slot + 1 & mask
                table[slot], values[slot] = h, pieces[piece][0]
            scores = np.full(1 << bits, -INF)
            score_of = {i: s for i, s in pieces.values()}
            full = values >= 0
            scores[full] = [score_of[i] for i in values[full].tolist()]
            self.by_length[n] = (table, values, scores, np.uint64(mask))

    @staticmethod
    def further(hashes: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The hashes of strings that are one character longer."""
        out = (hashes ^ char) * GOLDEN
        return out ^ (out >> np.uint64(29))

    def hashed(self, chars: np.ndarray) -> np.ndarray:
        out = np.zeros(len(chars), np.uint64)
        for k in range(chars.shape[1]):
            out = self.further(out, chars[:, k])
        return out

    def __call__(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """-1 and minus infinity where there is no piece with the hash."""
        own = self.by_length.get(length)
        if own is None:
            return np.full(len(hashes), -1, np.int32), np.full(len(hashes), -INF)
        table, values, scores, mask = own
        slot = (hashes & mask).astype(np.int64)
        ids, out = values[slot], scores[slot]
        wrong = np.flatnonzero((table[slot] != hashes) & (ids >= 0))
        while len(wrong):
            slot[wrong] = slot[wrong] + 1 & int(mask)
            ids[wrong], out[wrong] = values[slot[wrong]], scores[slot[wrong]]
            wrong = wrong[(table[slot[wrong]] != hashes[wrong]) & (ids[wrong] >= 0)]
        return ids, out


class Encoder:
    """N-best segmentation of whole texts, with a bounded memory of units."""

    def __init__(self, vocabulary: Vocabulary, n: int = N_BEST, known: int = KNOWN_UNITS):
        self.v, self.n, self.limit = vocabulary, n, known
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}        # of each known unit; what is known follows in arrays
        self.chars = 0
        self.ranked: dict[str, list] = {}
        self.ids, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score, self.gap = np.zeros(0), np.zeros(0)

    def learn(self, units: set[str]) -> None:
        lengths: dict[int, list[str]] = {}
        for u in units:
            lengths.setdefault(len(u), []).append(u)
        found, order = [], []
        for size, own in lengths.items():
            if size <= UNIT_CHARS:
                found.append(self.v.first_two(own))
                order += own
            else:
                for u in own:
                    found.append(tuple(np.atleast_1d(x) for x in self.v.slowly(u)))
                    order.append(u)
        if order:
            self.chars += sum(map(len, order))
            self.number.update(zip(order, range(len(self.number), len(self.number) + len(order))))
            ids, size, score, gap = (np.concatenate([x, *own]) for x, own in zip((self.ids, self.size, self.score, self.gap), zip(*found)))
            self.ids, self.size, self.score, self.gap, self.start = ids, size, score, gap, np.cumsum(size) - size

    def encode_all(self, texts: list[str | None]) -> list[list]:
        """For each text first the ids of the best segmentation, then (score, edits) of the n best. An edit
        (at, drop, put) replaces ``drop`` ids of the best at ``at`` by ``put``. Equal scores: the one that leaves the earlier
        units at better ranks comes first. Units that are new are searched together."""
        if len(self.number) > self.limit or len(self.ids) > 16 * self.limit or self.chars > KNOWN_CHARS:
            self.forget()
        units = [self.v.units(self.v.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(set().union(*units) - self.number.keys())
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(units)), np.int64)
        size = self.size[numbers]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(before[-1]) - np.repeat(before[:-1] - self.start[numbers], size)]
        score, gap = self.score[numbers], self.gap[numbers]
        out, a = [], 0
        for own in units:
            b = a + len(own)
            out.append([ids[before[a]:before[b]], *self._n_best(own, float(score[a:b].sum()), gap[a:b], before[a:b + 1] - before[a])])
            a = b
        return out

    def encode(self, text: str | None) -> list:
        return self.encode_all([text])[0]

    def _best(self, unit: str) -> list[tuple[float, tuple]]:
        hit = self.ranked.get(unit)
        if hit is None:
            hit = self.v.n_best(unit, self.n)
            if len(unit) <= UNIT_CHARS and len(self.ranked) < self.limit // 10:
                self.ranked[unit] = hit
        return hit

    def _n_best(self, units: list[str], score: float, gaps: np.ndarray, starts: np.ndarray) -> list[tuple[float, list[tuple[int, int, tuple]]]]:
        if not units or self.n == 1:
            return [(score, [])]
        gaps = gaps[::-1]
        few = np.argsort(gaps, kind="stable")[:self.n - 1]
        at = sorted(len(units) - 1 - int(k) for k in few if gaps[k] < INF)
        ranked = [self._best(units[u]) for u in at]
        # states: a rank for each chosen unit; each is reached from one other only
        heap = [(0.0, (0,) * len(at), 0)]
        out: list = []
        while heap and len(out) < self.n:
            lost, ranks, first = heapq.heappop(heap)
            edits = [(int(starts[at[k]]), int(starts[at[k] + 1] - starts[at[k]]), ranked[k][r][1]) for k, r in enumerate(ranks) if r]
            out.append((score - lost, edits))
            for k in range(first, len(at)):
                r = ranks[k] + 1
                if r < len(ranked[k]):
                    more = lost + ranked[k][r - 1][0] - ranked[k][r][0]
                    heapq.heappush(heap, (more, ranks[:k] + (r,) + ranks[k + 1:], k))
        return out


def edited(ids: list[int], edits: list[tuple[int, int, tuple]]) -> list[int]:
    out = list(ids)
    for at, drop, put in sorted(edits, reverse=True):
        out[at:at + drop] = put
    return out


EDIT = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("drop", T.IntegerType()),
                     T.StructField("put", T.ArrayType(T.IntegerType()))])
NBEST = T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(EDIT))]))
_LOADED: dict[tuple, Encoder] = {}


def _encoder(model: bytes, n: int) -> Encoder:
    key = (hash(model), n)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(Vocabulary(model), n)
    return _LOADED[key]


def encode(docs: DataFrame, model_path: str | None = None, n: int = N_BEST, text: str = "text") -> DataFrame:
    """Add to each row ``ids`` (the best segmentation), ``n_best`` (score and edits against ``ids``,
    best first) and ``decoded`` (the text that ``ids`` give back).

    Whole texts, no cap. Null and empty texts have no ids, one segmentation of score 0, and decode to
    the empty string. There are fewer than ``n`` segmentations if the text has fewer. Unknown
    characters become their bytes. Texts come back as they were, but for the space mark U+2581
    itself, which comes back as a space. The .model file is read once on the driver
    (half a megabyte here) and sent to the tasks. Other columns stay; clashing names are refused."""
    if clash := {"ids", "n_best", "decoded"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    with open(model_path or default_model(), "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType(docs.schema.fields + [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                                T.StructField("n_best", NBEST), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value, n)
        try:
            yield from encoded(batches, encoder)
        finally:
            encoder.forget()        # the worker may live on

    def encoded(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, BATCH_BYTES):
            found = encoder.encode_all(batch.column(text).to_pylist())
            sizes = np.cumsum([0] + [len(f[0]) for f in found]).astype(np.int32)
            flat = np.concatenate([f[0] for f in found])
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns["ids"] = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat, pa.int32()))
            columns["n_best"] = _nested([f[1:] for f in found])
            columns["decoded"] = pa.array([encoder.v.decode(f[0].tolist()) for f in found], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, schema)


def _nested(found: list[list[tuple]]) -> pa.Array:
    """The n best of each row as an array of struct<score, edits array<struct<at, drop, put array>>>."""
    flat = [s for row in found for s in row]
    edits = [e for s in flat for e in s[1]]

    def offsets(sizes):
        return pa.array(np.cumsum([0, *sizes]).astype(np.int32))

    put = pa.ListArray.from_arrays(offsets([len(e[2]) for e in edits]), pa.array([i for e in edits for i in e[2]], pa.int32()))
    edit = pa.StructArray.from_arrays([pa.array([e[0] for e in edits], pa.int32()), pa.array([e[1] for e in edits], pa.int32()), put],
                                      names=["at", "drop", "put"])
    score = pa.StructArray.from_arrays([pa.array([s[0] for s in flat], pa.float64()),
                                        pa.ListArray.from_arrays(offsets([len(s[1]) for s in flat]), edit)], names=["score", "edits"])
    return pa.ListArray.from_arrays(offsets([len(r) for r in found]), score)


def op3_sentencepiece(spark, sf_dir):
    """The four best segmentations of every document: their scores, digests of the best ids and of the edits, and
    whether the ids decode to the text."""
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.col("n_best.score").alias("scores"),
                      F.xxhash64("ids").alias("ids_xxhash64"), F.xxhash64("n_best.edits").alias("edits_xxhash64"),
                      (F.col("decoded") == F.regexp_replace(F.coalesce("text", F.lit("")), MARK, " ")).alias("round_trip"))
