"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are shuffled by their full text (equal ones are counted before the shuffle); every distinct text is tokenised twice and
cut where tokens of both end at one byte. The two tokens that end there are linked. Pair counts add up the links of a
text times the number of its copies. Measures of a text that need the counts of the whole corpus are made in two ways that together cover
every pair: the most frequent pairs, of a bounded number, are sent to the tasks; the others are joined by a shuffle, in which
no pair is frequent. At the end the measures are joined to the documents by a digest of the text; the rows of
the texts with the most copies are dealt to many tasks.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import batch_of, drop_saved, saved, sliced, table

FREQUENT_PAIRS = 500_000    # pairs whose counts are sent to every task: 8 MB
HOT_TEXTS = 1000            # texts with the most copies, whose rows are dealt out
HOT_ROWS = 50_000           # rows of one text that go to one task
BATCH_BYTES = 1 << 20
KNOWN_BYTES = 4 << 20       # of the chunks that a task remembers before it starts anew

_BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)")

_ALIGNED = pa.schema([("text_id", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                      ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])


def default_a() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def default_b() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the others follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers with the bytes of their tokens, and a bounded memory of what chunks of text align to.

    Neither has a token that reaches over a space between two other characters (if the vocabularies are of the kind
    where that holds; else a text is one chunk). So texts are cut before such spaces, and tokens and groups of a chunk don't
    depend on what stands around it. Chunks repeat a lot; new ones are tokenised together, one after the other in one string."""

    def __init__(self, a: str, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters, spec = _byte_letters(), json.loads(a)
        vocabulary = spec["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size, self.b_size = (np.array([len(t) for t in own]) for own in (self.a_bytes, self.b_bytes))
        # "id," "id|" and "id;" of every id
        self.names = [f"{i}{mark}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for mark in ",|;"]
        proto = pb.ModelProto()
        proto.ParseFromString(b)
        rules = proto.normalizer_spec
        pre = spec.get("pre_tokenizer") or {}
        self.cut = (not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and rules.add_dummy_prefix
                    and not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
                    and not any(re.search("[^▁]▁", p.piece) for p in proto.pieces))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}        # of each known chunk; what is known follows
        self.groups: list[str | None] = []      # null: the tokens don't give the chunk back
        self.sizes = np.zeros((0, 3), np.int64)     # tokens of A, of B, groups
        self.pairs, self.start, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def chunks(self, whole: str) -> list[str]:
        return _BEFORE_WORD.split(whole) if self.cut else [whole]

    def _tokens(self, chunk: str) -> tuple[np.ndarray, np.ndarray] | None:
        a, b, whole = self.a.encode(chunk, add_special_tokens=False).ids, self.b.encode(chunk[1:], num_threads=1), chunk.encode("utf-8", "replace")
        if b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b_bytes[i] for i in b]) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _aligned(self, a: np.ndarray, b: np.ndarray) -> tuple:
        """Bytes at which both have a token end, places of the tokens there, their pairs, and the names of all tokens by group: ids of
        A, a bar, ids of B, a semicolon."""
        common, at_a, at_b = np.intersect1d(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), assume_unique=True, return_indices=True)
        groups = np.arange(len(common))
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[at_a], mark_b[at_b] = 1, 2
        order = np.argsort(np.concatenate([2 * np.repeat(groups, np.diff(at_a, prepend=-1)), 2 * np.repeat(groups, np.diff(at_b, prepend=-1)) + 1]), kind="stable")
        return common, at_a, at_b, a[at_a] << 32 | b[at_b], np.concatenate([3 * a + mark_a, 3 * b + mark_b])[order].tolist()

    def learn(self, new: list[str]) -> None:
        """Remember new chunks."""
        plain = [c for c in new if self.cut and len(c) > 1 and c[0] == " " and not c[1].isspace() and not c[-1].isspace() and "▁" not in c]
        known = set(plain)
        parts = [(plain, self._tokens("".join(plain)))] if plain else []
        if parts and parts[0][1] is None:
            parts, known = [], set()
        parts += [([c], self._tokens(c)) for c in new if c not in known]
        sizes, pairs = [], []
        for own, tokens in parts:
            self.number.update(zip(own, range(len(self.groups), len(self.groups) + len(own))))
            if tokens is None:
                self.groups.append(None)
                sizes.append(np.zeros((1, 3), np.int64))
                continue
            common, at_a, at_b, linked, names = self._aligned(*tokens)
            ends = np.cumsum([len(c.encode("utf-8", "replace")) for c in own])
            last = np.searchsorted(common, ends)        # group, and tokens, that a chunk ends with
            n = np.column_stack([np.diff(x, prepend=-1) for x in (at_a[last], at_b[last], last)])
            cut = np.concatenate([[0], np.cumsum(n[:, 0] + n[:, 1])]).tolist()
            self.groups += ["".join([self.names[i] for i in names[x:y]]) for x, y in zip(cut, cut[1:])]
            sizes.append(n)
            pairs.append(linked)
        self.sizes = np.concatenate([self.sizes, *sizes])
        self.pairs = np.concatenate([self.pairs, *pairs])
        self.start = np.cumsum(self.sizes[:, 2]) - self.sizes[:, 2]
        self.bytes += sum(len(c) for c in new)

    def align(self, texts: list[str]) -> list[tuple]:
        """n_a, n_b, n_groups, digest of the groups, pairs (a << 32 | b, distinct) and how many links of the text hold each."""
        if self.bytes > KNOWN_BYTES:
            self.forget()
        cut = [self.chunks(" " + t) if t else [] for t in texts]
        self.learn(list(dict.fromkeys(c for own in cut for c in own if c not in self.number)))
        out = []
        for text, own in zip(texts, cut):
            numbers = [self.number[c] for c in own]
            groups = [self.groups[k] for k in numbers]
            if None in groups and len(own) > 1:
                self.learn([" " + text] if " " + text not in self.number else [])
                numbers = [self.number[" " + text]]
                groups = [self.groups[k] for k in numbers]
            if not own or None in groups:
                out.append((0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)))
                continue
            n = self.sizes[numbers]
            size = n[:, 2]
            at = np.arange(size.sum()) + np.repeat(self.start[numbers] - (np.cumsum(size) - size), size)
            pairs, links = np.unique(self.pairs[at], return_counts=True)
            out.append((*n.sum(axis=0).tolist(), hashlib.sha256("".join(groups)[:-1].encode()).hexdigest(), pairs, links))
        return out


@lru_cache(maxsize=1)
def _tokenizers(a: str, b: bytes) -> Tokenizers:
    return Tokenizers(a, b)


def _lists(own: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, own)]), pa.int32()), pa.array(np.concatenate(own) if own else [], pa.int64()))


def aligned(docs: DataFrame, text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row for each distinct text that is neither null nor empty: text_id (binary, SHA-256), copies, n_a, n_b, n_groups,
    groups_sha256, pairs (a << 32 | b) and links (how many of the text hold each pair). The vocabulary files are read once
    on the driver (two megabytes here) and sent to the tasks."""
    with open(a_path or default_a(), encoding="utf-8") as f:
        a = f.read()
    with open(b_path or default_b(), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((a, f.read()))
    texts = docs.select(F.col(text).alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(*shared.value)
        try:
            for batch in sliced(batches, "text", BATCH_BYTES):
                n_a, n_b, n_groups, digest, pairs, links = zip(*both.align(batch.column("text").to_pylist()))
                yield batch_of(_ALIGNED, {"text_id": batch.column("text_id"), "copies": batch.column("copies"), "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                                          "groups_sha256": digest, "pairs": _lists(pairs), "links": _lists(links)})
        finally:
            both.forget()       # the worker may live on

    return (texts.select(F.unhex(F.sha2("text", 256)).alias("text_id"), "copies", "text")
            .mapInArrow(run, "text_id binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, links array<long>"))


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold the pair, and whether no pair with the same B id has more."""
    counts = (texts.select("copies", F.explode(F.arrays_zip("pairs", "links")).alias("l"))
              .groupBy(F.col("l.pairs").alias("pair")).agg(F.sum(F.col("copies") * F.col("l.links")).alias("n")))
    counts = saved(counts, "alignment-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(highest, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _measured(texts: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """text_id, copies and the measures of each text."""
    top = counts.orderBy(F.desc("n"), "pair").limit(frequent).toPandas().sort_values("pair")     # at most ``frequent`` rows of 17 bytes
    shared = texts.sparkSession.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))
    kept = ["text_id", "copies", "n_a", "n_b", "n_groups", "groups_sha256"]
    schema = pa.schema([*(_ALIGNED.field(c) for c in kept), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("rare", _ALIGNED.field("pairs").type),
                        ("links", _ALIGNED.field("links").type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs, links = (batch.column(c).flatten().to_numpy() for c in ("pairs", "links"))
            size = np.diff(batch.column("pairs").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), size)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            weight, sums, hits = links[hit], np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, row[hit], weight * n[at[hit]])
            np.add.at(hits, row[hit], weight * best[at[hit]])
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))]), pa.int32())
            yield batch_of(schema, {**{c: batch.column(c) for c in kept}, "n_best": hits, "count_sum": sums,
                                    "rare": pa.ListArray.from_arrays(offsets, pa.array(pairs[~hit])), "links": pa.ListArray.from_arrays(offsets, pa.array(links[~hit]))})

    part = saved(texts.mapInArrow(run, "text_id binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, "
                                       "rare array<long>, links array<long>"), "alignment-part")
    rare = part.select("text_id", F.explode(F.arrays_zip("rare", "links")).alias("l")).select("text_id", F.col("l.rare").alias("pair"), F.col("l.links").alias("links"))
    more = (rare.join(counts, "pair").groupBy("text_id")
            .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum")))
    none = F.lit(0).cast("long")
    return (part.drop("rare", "links").join(more, "text_id", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", none)).withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", none))
            .drop("more_best", "more_sum"))


def align_tokenizers(docs: DataFrame, text: str = "text", a_path: str | None = None, b_path: str | None = None, frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """doc_id and, of its text, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum and groups_sha256.

    A is a byte-level vocabulary (a tokenizers file) on a space and the text, B a SentencePiece vocabulary that adds
    the space itself; special tokens are plain text. A group is the bytes between places where both have
    a token end; the two tokens that end there are linked. n_best counts the links whose pair no other with its B id exceeds in the
    corpus, count_sum adds the corpus counts of the links' pairs. Null and empty texts, and those that the tokens of A or B do not
    give back, have zeros and an empty groups_sha256. Every row comes back, repeated ones too; other columns go; no rows give no rows.
    ``frequent`` bounds the pairs that are sent to the tasks and changes no result."""
    texts = saved(aligned(docs, text, a_path, b_path), "alignment-texts")
    counts = saved(pair_counts(texts), "alignment-best")
    measured = saved(_measured(texts, counts, frequent), "alignment-measured")
    drop_saved(texts)
    hot = (measured.where(F.col("copies") > HOT_ROWS).orderBy(F.desc("copies"), "text_id").limit(HOT_TEXTS)
           .select("text_id", F.ceil(F.col("copies") / HOT_ROWS).cast("int").alias("parts")))
    hot = F.broadcast(saved(hot, "alignment-hot"))      # at most HOT_TEXTS rows
    rows = docs.select("doc_id", F.unhex(F.sha2(F.col(text), 256)).alias("text_id")).join(hot, "text_id", "left")
    rows = rows.select("doc_id", "text_id", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)).cast("int").alias("part"))
    dealt = (measured.join(hot, "text_id", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))))
    joined = rows.join(dealt.drop("parts", "copies"), ["text_id", "part"], "left")
    none = F.lit(0).cast("long")
    return joined.select("doc_id", *(F.coalesce(c, none).alias(n) for c, n in (("n_a", "n_a"), ("n_b", "n_b"), ("n_groups", "n_groups"), ("n_groups", "n_links"),
                                                                               ("n_best", "n_best"), ("count_sum", "count_sum"))),
                         F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_tokenizer_alignment(spark, sf_dir):
    """Alignment of the byte-level and the piece vocabulary over all documents."""
    return align_tokenizers(table(spark, sf_dir, "documents"))
