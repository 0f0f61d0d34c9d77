import hashlib
import random

import numpy as np
import pytest
from conftest_paths import SF001
from helpers import ODD_ROWS, docs_of, long_text

from cartwheel.llm.chunks import GEAR, LEAST, MOST, chunk_ends, dedup_chunks, gear_hashes, op8_chunk_dedup


def ends_of(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return chunk_ends(raw, np.array([0, len(raw)]))[0]


def test_gear_hash_is_the_rolling_one():
    data = np.random.default_rng(1).integers(0, 256, 500).astype(np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert gear_hashes(data).tolist() == want


def test_chunks_cover_the_text_and_resist_insertions():
    text = long_text(1, 3000)
    ends = ends_of(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and min(sizes[:-1]) >= LEAST and max(sizes) <= MOST
    raw = text.encode()
    pieces = lambda t, e: {t[a:b] for a, b in zip([0, *e], e)}
    other = "some new words " + text[:6000] + "inserted" + text[6000:]
    a, b = pieces(raw, ends), pieces(other.encode(), ends_of(other))
    assert len(a & b) > 0.95 * len(a)


def test_characters_stay_whole_and_long_runs_are_cut():
    text = "漢字é\U0001F600" * 2000 + "a" * 3 * MOST
    raw = text.encode()
    for a, b in zip([0, *ends_of(text)], ends_of(text)):
        raw[a:b].decode()
        assert b - a <= MOST
    assert ends_of("") == [] and ends_of("short") == [5]


def brute(rows):
    """What stays of each (doc_id, text), by the same chunks: the first copy in order."""
    seen, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        raw, e = (t or "").encode(), ends_of(t or "")
        kept, gone = [], 0
        for a, b in zip([0, *e], e):
            first = seen.setdefault(raw[a:b], (d, a))
            if first == (d, a):
                kept.append(raw[a:b])
            else:
                gone += b - a
        out[d] = (gone, b"".join(kept))
    return out


def test_against_brute_force(spark):
    r = random.Random(2)
    shared = [long_text(i, 120) for i in range(4)]
    rows = [(i, " ".join(r.choice([r.choice(shared), long_text(100 + i, 60)]) for _ in range(3)), None) for i in range(60)]
    want = brute([x[:2] for x in rows])
    got = {x.doc_id: (x.n_removed, bytes(x.kept)) for x in dedup_chunks(docs_of(spark, rows)).collect()}
    assert got == want
    assert sum(g[0] for g in got.values()) > 10_000


def test_odd_rows(spark):
    got = dedup_chunks(docs_of(spark, ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    assert [r.n_removed for r in got if r.doc_id == 1] == [0, 0]
    assert all(r.n_bytes == len((r.text or "").encode()) for r in got)
    assert dedup_chunks(docs_of(spark, [])).collect() == []
    with pytest.raises(ValueError):
        dedup_chunks(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {d: (g, hashlib.sha256(k).hexdigest()) for d, (g, k) in brute(rows).items()}
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in op8_chunk_dedup(spark, SF001).collect()} == want
