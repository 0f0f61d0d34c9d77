"""Byte-level BPE of whole texts.

The split pattern cuts a text into words, by Spark. Words repeat, so a task merges each distinct word of a slice of its rows once, by a heap,
and remembers words from slice to slice, of a bounded number; the tokens of all the slice's words are then gathered by Arrow. Nothing of the
corpus passes through the driver, and no task needs words of another. Decoding concatenates the bytes of the pieces.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import SLICE_BYTES, table

KNOWN_WORDS = 200_000       # words that a task remembers
KNOWN_BYTES = 64            # of the longest word that is remembered


def default_ranks() -> str:
    """The public rank file of the box; any other may be given instead."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def char_of(token: int) -> str:
    """The character that stands for a token: past the first 256, without the surrogates, in the order of the ranks."""
    return chr(token + 0x100 if token < 0xD700 else token + 0x900)


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?U){pattern}"), F.lit(0))     # \\s as the Unicode white space


def _slices(rows: pa.ListArray) -> Iterator[pa.ListArray]:
    """The rows again, in parts of at most SLICE_BYTES bytes of words (or one row)."""
    ends = np.frombuffer(rows.values.buffers()[1], np.int32)[rows.values.offset:][rows.offsets.to_numpy()] if len(rows.values) else np.zeros(len(rows) + 1, np.int32)
    i = 0
    while i < len(rows):
        j = max(i + 1, int(np.searchsorted(ends, int(ends[i]) + SLICE_BYTES, side="right")) - 1)
        yield rows.slice(i, min(j, len(rows)) - i)
        i = j


def _joined(ends: np.ndarray, data) -> pa.Array:
    """Binary values that lie one after the other."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), data])


def _coded(rows: pa.ListArray, merged: Callable[[bytes], bytes], pieces: pa.Array) -> pa.Array:
    """ids and decoded of rows of words."""
    at = rows.offsets.to_numpy()
    words = rows.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
    codes = [merged(w) for w in words.dictionary.to_pylist()]
    sizes = np.array([0, *map(len, codes)], np.int64) // 4
    tokens = pa.ListArray.from_arrays(pa.array(sizes.cumsum(), pa.int32()), pa.array(np.frombuffer(b"".join(codes), "<u4"))).take(words.indices)
    ids = tokens.flatten()
    at = (tokens.offsets.to_numpy() - tokens.offsets[0].as_py())[at - at[0]]
    bytes_ = pieces.take(ids)
    ends = np.frombuffer(bytes_.buffers()[1], np.int32)[bytes_.offset:] if len(bytes_) else np.zeros(1, np.int32)
    return pa.StructArray.from_arrays([_joined(4 * at.astype(np.int64), pa.py_buffer(ids.to_numpy().astype("<u4", copy=False))),
                                       _joined(ends[at], bytes_.buffers()[2] or pa.py_buffer(b""))], names=["ids", "decoded"])


def heap_merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of one word: of all pairs the one of the lowest rank is merged first, the leftmost of equal ones."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))             # of the part that starts at a place; 0: none does
    back = list(range(-1, n))               # start of the part before
    heap = []

    def push(a: int) -> None:
        b = end[a]
        if b < n and (rank := ranks.get(word[a:end[b]])) is not None:
            heapq.heappush(heap, (rank, a, b, end[b]))

    for a in range(n - 1):
        push(a)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if end[a] != b or end[b] != c:      # one of the two is in another part by now
            continue
        end[a], end[b] = c, 0
        if c < n:
            back[c] = a
        push(a)
        if a:
            push(back[a])
    out, a = [], 0
    while a < n:
        out.append(ranks[word[a:end[a]]])
        a = end[a]
    return out


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, text: str = "text", known_words: int = KNOWN_WORDS) -> DataFrame:
    """Add to each row n_tokens (long), ids (binary: unsigned 32-bit integers, little end first) and decoded (binary: the
    bytes of the pieces, one after the other). No special tokens.

    Whole texts, no cap. Null and empty texts have no tokens and decode to no bytes; repeated rows are encoded alike; no rows
    give no rows. Letters, numbers and white space are those of the Java version's Unicode. Other columns stay; names that clash are
    refused. ``known_words`` bounds the words that a task remembers and changes no result."""
    if clash := {"n_tokens", "ids", "decoded", "_coded"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    ranks = read_ranks(ranks_path or default_ranks())
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"no token for the bytes {missing}")
    given = docs.sparkSession.sparkContext.broadcast(ranks)      # the vocabulary: its size is the file's

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = given.value
        tokens = {rank: token for token, rank in ranks.items()}
        pieces = pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.binary())

        def fresh(word: bytes) -> bytes:
            return np.array(heap_merged(word, ranks), "<u4").tobytes()

        known = lru_cache(known_words)(fresh)

        def merged(word: bytes) -> bytes:
            return known(word) if len(word) <= KNOWN_BYTES else fresh(word)

        for batch in batches:
            for rows in _slices(batch.cast(pa.list_(pa.binary()))):
                yield _coded(rows, merged, pieces)

    kept = [f"`{c}`" for c in docs.columns]
    out = docs.select(*kept, coded(words_of(F.col(text), pattern or default_pattern())).alias("_coded"))
    out = out.select(*kept, *(F.col(f"_coded.{c}").alias(c) for c in ("ids", "decoded")))
    return out.select(*kept, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


def op13_byte_bpe(spark, sf_dir):
    """Tokens of every document and the bytes that they decode to."""
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                      (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))
