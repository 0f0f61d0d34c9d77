import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest_paths import SF001
from helpers import ODD_ROWS, docs_of, long_text

from cartwheel.llm.byte_bpe import char_of, default_ranks, encode, heap_merged, read_ranks
from cartwheel.llm.queries import QUERIES

RANKS = read_ranks(default_ranks())


def library(ranks=RANKS):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ROWS = ODD_ROWS + [(7, "don't  we'll\t\tit's \n\n end ", None), (8, "\x00\x01 \x00\x1c \x85\xa0 x ​z", None), (9, "<|endoftext|>", None),
                   (10, "!" * 500 + "q" * 3000 + " " * 200 + "7" * 90, None), (11, "antidisestablishmentarianism " * 9, None), (12, long_text(8, 4000), None),
                   (13, "१२३ ½ Ⅷ ١٢٣ नमस्ते दुनिया \U0001F469‍\U0001F680", None)]


@pytest.mark.parametrize("known", [100_000, 1])
def test_equals_the_library(spark, known):
    own = library()
    got = encode(docs_of(spark, ROWS), known_words=known).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in ROWS)
    for r in got:
        ids = own.encode_ordinary(r.text or "")
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (r.text or "").encode()


def test_other_vocabulary(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    own = library(read_ranks(path))
    for r in encode(docs_of(spark, ROWS), ranks_path=path, known_words=5).collect():
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == own.encode_ordinary(r.text or "")


def test_heap_and_unbroken_million():
    own, r = library(), random.Random(2)
    for n in (1, 2, 3, 50, 400):
        for letters in ("ab", "the quick", "a", "\xff\xfe\x80é"):
            word = "".join(r.choice(letters.replace(" ", "")) for _ in range(n))
            assert heap_merged(word.encode(), RANKS) == own._encode_single_piece(word.encode())
    assert sum(len(own.decode_bytes([t])) for t in heap_merged(b"acgt" * 250_000, RANKS)) == 1_000_000


def test_characters_of_tokens():
    chars = [char_of(i) for i in range(200_000)]
    assert chars == sorted(set(chars)) and not any(0xD800 <= ord(c) < 0xE000 or ord(c) < 256 for c in chars)


def test_empty_tables_and_clashes(spark):
    assert encode(docs_of(spark, [])).collect() == []
    assert [bytes(r.ids) for r in encode(docs_of(spark, [(1, None, "x"), (2, "", "y")])).collect()] == [b"", b""]
    with pytest.raises(ValueError):
        encode(docs_of(spark, ODD_ROWS).withColumnRenamed("shard", "IDS"))


def test_query(spark):
    own = library()
    got = {r.doc_id: r for r in QUERIES["op13_byte_bpe"](spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array(own.encode_ordinary(r.text or ""), "<u4").tobytes()
        assert tuple(got[r.doc_id])[:4] == (r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
        assert got[r.doc_id].round_trip


def test_nothing_of_the_corpus_passes_through_the_driver(spark):
    spark.sparkContext.setJobGroup("bpe-plan", "")
    got = encode(docs_of(spark, ROWS))
    assert "subquery" not in got._jdf.queryExecution().executedPlan().toString().lower()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("bpe-plan")


def test_rows_over_several_slices(spark):
    """More text than a slice holds, in one batch: rows of it and rows of none, and one row that alone is over it."""
    own = library()
    rows = [(i, None if i % 50 == 3 else "" if i % 50 == 4 else long_text(i % 7, 3000), None) for i in range(150)] + [(150, long_text(9, 300_000), None)]
    docs = docs_of(spark, rows).coalesce(1)
    got = {r.doc_id: r for r in encode(docs, known_words=50).collect()}
    assert len(got) == len(rows) and sum(len(r[1] or "") for r in rows) > 2 << 20
    for doc_id, text, _ in rows:
        assert np.frombuffer(bytes(got[doc_id].ids), "<u4").tolist() == own.encode_ordinary(text or "")
        assert bytes(got[doc_id].decoded) == (text or "").encode()
