"""Near duplicates by a chosen-path similarity join.

Each document is the set of its shingles, of five words if not asked otherwise, and links to every document with a Jaccard
similarity of 0.8 or more. A tree starts from all documents. A node chooses places of the minhash
signature at random and sends each document to one child per place, named by the document's minwise
token there; similar documents stay together with the probability of their similarity at each place. Small
nodes compare all their documents; large nodes branch again. ``TREES`` independent trees make the chance to miss a
pair vanish: a pair at 0.8 meets in 8 of 10 trees on average, and in none with 0.2 ** 10.

What makes groups of many copies cheap: equal sets are one row from the start. In every first node all documents are first compared
with the smallest one; links are confirmed on full sets and joined to components. Pairs inside one
component need no comparison, so afterwards only nodes with several components matter, and in them the documents outside the largest
component: these few are compared with all. A node with more than ``SMALL`` of them branches. Comparing happens inside the
tasks: first on sketches, which leaves the rows that have a possible partner, then on their full sets. Only
links become rows, and a pair is compared in the first node that it shares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import GOLDEN, MIX1, MIX2, batch_of, bytes_of, drop_saved, mixed, saved, sliced, table

PERCENT = 80
WORDS = 5               # of a shingle
PLACES = 64             # of the minhash signature
TREES = 10
SMALL = 8000            # documents outside its largest component that a node compares with all
BLOCK = 4096            # documents of the largest component that one task compares with them
BRANCH = 2.5            # children of a document in a large node, on average
DEPTH = 6               # deeper nodes are compared in pairs of blocks, whatever their size
# Two sets with similarity 0.8 agree in 51 of 64 places on average, with a deviation of 3.2; fewer than this many, six deviations, are not looked at further.
AGREE = 32
ID_BITS = 1 << 28       # of the largest bitmap of documents whose sets are needed: 32 MB

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_FACTORS = mixed((np.arange(PLACES, dtype=np.uint64) + np.uint64(101)) * GOLDEN) | np.uint64(1)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of data[start:end]: eight bytes after eight are put in and mixed, so there is no structure that texts could collide by."""
    eights = np.ndarray(max(1, len(data)), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
    size = end - start
    out = mixed(size.astype(np.uint64) * GOLDEN + np.uint64(seed))
    live = np.arange(len(start))
    for k in range(0, int(size.max(initial=0)), 8):
        live = live[size[live] > k]
        some = eights[start[live] + k]
        missing = np.uint64(8) * np.maximum(k + 8 - size[live], 0).astype(np.uint64)
        out[live] = mixed((out[live] ^ (some << missing >> missing)) * MIX2 + GOLDEN)
    return out


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of so many words of texts one after the other (of all words, if there are fewer), and which text each is of."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _LOWER[data]
    word = ~_BLANK[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(word & (edge[:-1] | np.concatenate([[True], ~word[:-1]])))
    end = np.flatnonzero(word & (edge[1:] | np.concatenate([~word[1:], [True]]))) + 1
    hashes = word_hashes(low, start, end, seed)
    doc = np.searchsorted(offsets, start, side="right") - 1
    some = max(0, len(doc) - words + 1)
    full = np.flatnonzero(doc[words - 1:words - 1 + some] == doc[:some])
    values = hashes[full]
    for k in range(1, words):
        values = mixed(values * MIX1 + hashes[full + k])
    count = np.bincount(doc, minlength=len(offsets) - 1)[doc]
    short = np.flatnonzero((count < words) & np.concatenate([[True], doc[1:] != doc[:-1]])[:len(doc)])
    rest = hashes[short]
    for k in range(1, words - 1):
        more = np.flatnonzero(count[short] > k)
        rest[more] = mixed(rest[more] * MIX1 + hashes[short[more] + k])
    values, of = np.concatenate([values, mixed(rest ^ MIX2)]), np.concatenate([doc[full], doc[short]])
    order = np.argsort(of, kind="stable")
    return values[order], of[order]


def _sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return [s for s, _ in _sets_and_digests(column, words, digests=False)]


def _sets_and_digests(column: pa.Array, words: int, digests: bool = True) -> Iterator[tuple[np.ndarray, bytes]]:
    """The sorted distinct shingle hashes of each text, and a 128-bit digest of the set, made of these and of a second hash of each
    shingle: documents count as equal by 128 bits a shingle."""
    data, offsets = bytes_of(column)
    values, doc = shingles(data, offsets, words)
    second = shingles(data, offsets, words, seed=1)[0] if digests else values
    cuts = np.searchsorted(doc, np.arange(len(offsets)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        own, first = np.unique(values[a:b], return_index=True)
        yield own, hashlib.blake2b(own.tobytes() + second[a:b][first].tobytes(), digest_size=16).digest() if digests else b""


_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("sig", pa.list_(pa.int32()))])


def features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Of (doc_id, text): set size, 128-bit digest of the set, minhash signature (null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            sets, digests = zip(*_sets_and_digests(batch.column("text"), words))
            sizes = np.array([len(s) for s in sets])
            keys = np.frombuffer(b"".join(digests), np.int64)
            full = np.flatnonzero(sizes)
            sig = np.zeros((len(sets), PLACES), np.int32)
            if len(full):
                flat, at = np.concatenate(sets), (np.cumsum(sizes) - sizes)[full]
                for i, factor in enumerate(_FACTORS):
                    sig[full, i] = np.minimum.reduceat((flat * factor) >> np.uint64(33), at).astype(np.int32)
            yield batch_of(_FEATURES, {
                "doc_id": batch.column("doc_id"), "n_shingles": sizes, "k1": keys[::2], "k2": keys[1::2],
                "sig": pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, PLACES), pa.int32()), pa.array(sig.ravel()),
                                                mask=pa.array(sizes == 0))})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, sig array<int>")


def shingle_sets(docs: DataFrame, need: DataFrame, words: int = WORDS) -> DataFrame:
    """Of (doc_id, text): the sorted shingle hashes, packed, of the documents whose doc_id is needed, and of few others.

    The needed ids are sent as a bitmap of their hashes, with 16 bits for each, so no text is shuffled; if that would take
    more than ``ID_BITS`` bits, the texts are joined to the ids."""
    bits = 1 << max(20, (16 * need.count()).bit_length())
    if bits > ID_BITS:
        return _sets_by_join(docs, need, words)
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    parts = (need.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    wanted = docs.sparkSession.sparkContext.broadcast({int(r.part): bytes(r.bits) for r in parts})

    def run(batches):
        bits = {k: np.unpackbits(np.frombuffer(v, np.uint8), bitorder="little").astype(bool) for k, v in wanted.value.items()}
        for batch in sliced(batches, "text"):
            part, place = batch.column("part").to_numpy(), batch.column("place").to_numpy()
            own = [k for k in range(batch.num_rows) if part[k] in bits and bits[part[k]][place[k]]]
            batch = batch.take(pa.array(own, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in _sets(batch.column("text"), words)], pa.binary())],
                                             names=["rep", "set"])

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", bit.alias("bit"))
    return (rows.select("doc_id", "text", F.bitmap_bucket_number("bit").alias("part"), F.bitmap_bit_position("bit").alias("place"))
            .mapInArrow(run, "rep long, set binary"))


def _sets_by_join(docs: DataFrame, need: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in _sets(batch.column("text"), words)], pa.binary())],
                                             names=["rep", "set"])

    return docs.join(need, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(run, "rep long, set binary")


# connected components ----------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of the edges (a, b) reaches, smallest nodes themselves left out.
    Large-star and small-star steps in turn, on the edges alone, until every component is a star around its
    smallest node; the number of steps grows with the logarithm of the size."""
    now = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    # links are few next to the documents: as many tasks as they fill, which adaptive execution would also come to
    tasks = max(6, now.count() // 100_000)
    while not _stars(now, tasks):
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).coalesce(tasks)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks).distinct().coalesce(tasks)
        # small star: the node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").coalesce(tasks).distinct())
        after = saved(small.coalesce(tasks), "edges")
        drop_saved(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _stars(edges: DataFrame, tasks: int) -> bool:
    """Whether no node has two smaller neighbours, or both a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return (ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where("up > 1 OR up > 0 AND down > 0").coalesce(tasks).isEmpty())


# the join ----------------------------------------------------------------------------------------

def _sketch():
    return F.transform("sig", lambda x: (x.bitwiseAND(F.lit(255)) - 128).cast("tinyint"))


def _sizes_agree(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=1) >= AGREE


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int8)
    return flat.reshape(len(column), PLACES)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _with_first(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of each document with the smallest of its node, where the sketches agree. rows: (node, rep, n, sketch, label)."""
    first = rows.groupBy("node").agg(F.min(F.struct("rep", "n", "sketch", "label")).alias("f"))
    pairs = rows.join(first, "node").where("rep > f.rep AND label <> f.label")
    pairs = pairs.select(F.col("f.rep").alias("a"), F.col("rep").alias("b"), F.col("f.n").alias("na"), F.col("n").alias("nb"),
                         F.col("f.sketch").alias("sa"), F.col("sketch").alias("sb"))

    def run(batches):
        for t in batches:
            if t.num_rows:
                near = _sizes_agree(t.column("na").to_numpy(), t.column("nb").to_numpy(), percent)
                near &= _agree(_matrix(t.column("sa")), _matrix(t.column("sb")))
                at = pa.array(np.flatnonzero(near))
                yield pa.RecordBatch.from_arrays([t.column("a").take(at), t.column("b").take(at)], schema=_PAIR)

    return pairs.mapInArrow(run, "a long, b long").distinct()


def _similar(x: bytes, y: bytes, percent: int) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _compared(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Compare documents of different components inside each node. rows: (node, rep, n, label, minor, lead, tree, roots,
    open, sketch). Of a pair one is ``minor``, outside the node's largest component; both only in the ``lead`` block of a node. A
    pair that shares an earlier tree which is ``open`` (a bit for each tree) is compared there.

    Without ``exact`` the rows that have a partner by their sketches; with it, and full sets in ``set``, the links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            node = t["node"].to_numpy()
            other = np.flatnonzero(node != node[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            rest = t.slice(cut)
            if cut:
                yield from compared(t.slice(0, cut).combine_chunks())
        if rest is not None:
            yield from compared(rest.combine_chunks())

    def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
        node, rep, n, label, minor, lead, tree, opened = (t[c].to_numpy() for c in ("node", "rep", "n", "label", "minor", "lead", "tree", "open"))
        sketch, roots = _matrix(t["sketch"].combine_chunks()), t["roots"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        bits = np.int64(1) << np.arange(roots.shape[1])

        def near(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keep = (label[i] != label[j]) & np.where(minor[i] & minor[j], lead[i], minor[i] | minor[j]) & _sizes_agree(n[i], n[j], percent)
            i, j = i[keep], j[keep]
            before = (roots[i] == roots[j]) & ((opened[i][:, None] & bits) > 0) & (np.arange(roots.shape[1]) < tree[i][:, None])
            keep = _agree(sketch[i], sketch[j]) & ~before.any(axis=1)
            return i[keep], j[keep]

        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        size = np.diff(np.append(starts, len(node)))
        few = np.repeat(size <= 32, size)
        found = []
        for lag in range(1, 32):        # small nodes, all at once
            i = np.flatnonzero((node[lag:] == node[:-lag]) & few[lag:])
            if not len(i):
                break
            found.append(near(i, i + lag))
        for s, e in zip(starts[size > 32].tolist(), (starts + size)[size > 32].tolist()):
            own = np.arange(s, e)
            outside = own[minor[s:e]]
            for i in outside.tolist():
                j = own[~minor[s:e] | (own > i)]
                found.append(near(np.full(len(j), i), j))
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        if not exact:
            some = np.zeros(len(node), bool)
            some[i] = some[j] = True
            yield from t.filter(pa.array(some)).combine_chunks().to_batches()
            return
        sets = t["set"].combine_chunks()
        keep = [k for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())) if _similar(sets[x].as_py(), sets[y].as_py(), percent)]
        a, b = rep[i[keep]], rep[j[keep]]
        yield batch_of(_PAIR, {"a": np.minimum(a, b), "b": np.maximum(a, b)})

    dealt = rows.repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(run, "a long, b long") if exact else dealt.mapInArrow(run, rows.schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar."""
    joined = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("sb")), "b")
              .join(sets.select(F.col("rep").alias("a"), F.col("set").alias("sa")), "a").select("a", "b", "sa", "sb"))

    def run(batches):
        for batch in sliced(batches, "sa", 1 << 22):
            same = [_similar(x, y, percent) for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())]
            at = pa.array(np.flatnonzero(same))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], schema=_PAIR)

    return joined.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, trees: int = TREES, small: int = SMALL, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) and kept of documents (doc_id long, text).

    Links need 100 * intersection >= percent * union of the sets of shingles of so many ``words`` (a text of
    fewer has one shingle, all its words; words are cut at white space, A-Z lowered). Texts without words have an empty set and no links. Rows that share a
    doc_id are one document with the links of all of them. Rows without a doc_id take part; a group of
    none but such rows has no component_id and all are kept. Null is empty; no rows give no rows. Other columns go. ``percent``
    has to be 80 or more: below, the sketch would lose links."""
    if not 100 >= percent >= PERCENT:
        raise ValueError(f"the sketch and the number of trees are made for {PERCENT} to 100 percent")
    docs = docs.select("doc_id", "text")
    own = saved(features(docs, words), "near-features")
    classes = saved(own.where("n_shingles > 0").groupBy("k1", "k2")
                    .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "near-classes")
    known = classes.where("rep IS NOT NULL")
    reps = known.select("rep", "n", _sketch().alias("sketch"), F.slice("sig", 1, trees).alias("roots"))
    labels: DataFrame | None = None
    sets: DataFrame | None = None

    def labelled(rows: DataFrame) -> DataFrame:
        if labels is None:
            return rows.withColumn("label", F.col("rep"))
        return (rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                .withColumn("label", F.coalesce("label", "rep")))

    def with_sets(need: DataFrame) -> DataFrame:
        """The sets of (at least) the needed documents; each is computed once."""
        nonlocal sets
        need = saved(need.select(F.col("rep").alias("doc_id")).distinct(), "near-need")
        if sets is not None:
            need = saved(need.join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti"), "near-need")
            if need.isEmpty():
                return sets
        # a class is known by its first document; equal rows and doc_ids are met once
        more = shingle_sets(docs, need, words).distinct()
        if sets is not None:
            more = more.join(sets.select("rep"), "rep", "left_anti")
        more = saved(more, "near-sets")
        sets = more if sets is None else sets.unionByName(more)
        return sets

    def link(links: DataFrame) -> None:
        """Join the components that new links connect."""
        nonlocal labels
        links = saved(links, "near-links")
        if not links.isEmpty():
            old = [] if labels is None else [labels.select(F.col("node").alias("a"), F.col("label").alias("b"))]
            labels = components(reduce(DataFrame.unionByName, old, links))

    def mixed_nodes(rows: DataFrame) -> DataFrame:
        """The rows of nodes with more than one component: whether a row is outside the largest, how many are, and in how many
        blocks the largest is."""
        kinds = rows.groupBy("node", "label").agg(F.count("*").alias("c"))
        node = (kinds.groupBy("node").agg(F.sum("c").alias("size"), F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("labels"))
                .where("labels > 1").select("node", "top.label", (F.col("size") - F.col("top.c")).alias("outside"),
                                            F.ceil(F.col("top.c") / BLOCK).cast("int").alias("blocks")).withColumnRenamed("label", "largest"))
        return rows.join(node, "node").withColumn("minor", F.col("label") != F.col("largest")).drop("largest")

    def compare(rows: DataFrame) -> None:
        """Link the rows of mixed nodes, each compared by the documents outside its largest component."""
        own = F.when(F.col("minor"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int")))
        opened = (rows.where("tree >= 0").groupBy("rep")
                  .agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("open")))
        dealt = (rows.join(opened, "rep", "left").withColumn("open", F.coalesce("open", F.lit(0).cast("long")))
                 .withColumn("block", F.explode(own)).withColumn("lead", F.col("block") == 0)
                 .withColumn("node", F.when(F.col("lead"), F.col("node")).otherwise(F.xxhash64("node", "block"))).join(reps, "rep")
                 .select("node", "rep", "n", "label", "minor", "lead", "tree", "roots", "open", "sketch"))
        some = saved(_compared(dealt, percent, exact=False), "near-partners")
        if not some.isEmpty():
            link(_compared(some.join(with_sets(some), "rep"), percent, exact=True))

    root = F.array(*[F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.col("sig")[t % PLACES]).alias("node")) for t in range(trees)])
    nodes = known.select("rep", F.inline(root))
    for depth in range(DEPTH + 1):
        shared = nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1").select("node")
        rows = saved(nodes.join(shared, "node").select("node", "rep", "tree"), "near-nodes")
        if not depth:
            first = saved(_with_first(labelled(rows).join(reps, "rep"), percent), "near-pairs")
            if not first.isEmpty():
                ends = first.select(F.col("a").alias("rep")).unionByName(first.select(F.col("b").alias("rep")))
                link(_confirmed(first, with_sets(ends), percent))
        mixed = mixed_nodes(labelled(rows))
        if depth == DEPTH:
            mixed = _blocks(mixed, small)
        else:
            whole = saved(mixed, "near-mixed")
            large = whole.where(F.col("outside") > small)
            mixed = whole.where(F.col("outside") <= small)
        compare(mixed)
        if depth == DEPTH:
            break
        # what is large still branches, where the new links left it more than one component
        large = mixed_nodes(labelled(large.select("node", "rep", "tree"))).select("node", "rep")
        children = F.filter(F.transform("sig", lambda v, i: F.when(
            F.pmod(F.xxhash64("node", i), F.lit(1000)) < int(1000 * BRANCH / PLACES), F.xxhash64("node", i, v))), lambda c: c.isNotNull())
        nodes = saved(large.join(known.select("rep", "sig"), "rep")
                      .select("rep", F.lit(-1).alias("tree"), F.explode(children).alias("node")), "near-children")
        for done in (rows, whole):
            drop_saved(done)
        if nodes.isEmpty():
            break
    group = classes.select("k1", "k2", "rep")
    group = (group.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("label", "rep").alias("component_id"))
             if labels is not None else group.withColumnRenamed("rep", "component_id"))
    out = own.select("doc_id", "n_shingles", "k1", "k2").join(group, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Nodes that never got small, as pairs of blocks: each row goes to every pair that its block is in. Exact, and no
    task holds a whole node."""
    count = rows.groupBy("node").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("rep", F.lit(5)), F.col("parts")).cast("int")
    return (rows.join(count, "node").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("node", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")))
            .withColumn("blocks", F.lit(1)).withColumn("minor", F.lit(True)).withColumn("tree", F.lit(-1)).drop("own", "other", "parts"))


def op9_near_duplicates(spark, sf_dir):
    """Components of near duplicates over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
