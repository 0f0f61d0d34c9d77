import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_paths import SF001
from helpers import ODD_ROWS, docs_of

from cartwheel.llm import repeats
from cartwheel.llm.repeats import anchors, lpf, nearest_smaller, op7_suffix_repeats, remove_repeats, repeated_windows


def brute(texts, length, first=False):
    """Removed-byte masks. texts: list of (order key, bytes); with ``first`` the earliest copy stays."""
    seen = {}
    for key, t in sorted(texts, key=lambda x: x[0]):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i:i + length], []).append((key, i))
    masks = []
    for key, t in texts:
        m = bytearray(len(t))
        for i in range(len(t) - length + 1):
            places = seen[t[i:i + length]]
            if (min(places) != (key, i)) if first else len(places) > 1:
                m[i:i + length] = b"\1" * length
        masks.append(bytes(m))
    return masks


def summary(t, mask):
    return len(t), sum(mask), len(re.findall(b"\1+", mask)), bytes(b for b, x in zip(t, mask) if not x)


def near_copies(seed, n=40, size=700):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé ") for _ in range(6))
    shared = ["".join(word() for _ in range(r.randint(20, 90))) for _ in range(5)]
    rows = []
    for i in range(n):
        t = "".join(r.choice([r.choice(shared), "".join(word() for _ in range(40))]) for _ in range(r.randint(1, 4)))
        if r.random() < 0.5 and t:
            k = r.randrange(len(t))
            t = t[:k] + "X" + t[k + 1:]
        rows.append((i, t[:size * 3], None))
    return rows + [(n, "ab" * 600, None), (n + 1, "ab" * 300 + "c", None), (n + 2, "z" * 500, None)]


def test_nearest_smaller():
    r = np.random.default_rng(1)
    for values in [r.permutation(200), np.arange(50), np.arange(50)[::-1].copy(), np.zeros(0, int)]:
        want = [max([j for j in range(i) if values[j] < values[i]], default=-1) for i in range(len(values))]
        assert nearest_smaller(values).tolist() == want


@pytest.mark.parametrize("seed", range(4))
def test_lpf_against_definition(seed):
    r = np.random.default_rng(seed)
    text = r.integers(0, 3, 90).astype(np.uint8)
    raw = text.tobytes()
    want = [max([next((k for k in range(90) if i + k >= 90 or raw[j + k] != raw[i + k]), 90) for j in range(i)], default=0) for i in range(90)]
    assert lpf(text, 16).tolist() == [min(w, 16) for w in want]


@pytest.mark.parametrize("length", [8, 20, 130])
def test_repeated_windows_agree_with_lpf(length):
    r = np.random.default_rng(length)
    part = r.integers(0, 250, 300).astype(np.uint8)
    text = np.concatenate([part, r.integers(0, 250, 50).astype(np.uint8), part[40:], part[:150]])
    starts = np.arange(len(text) - length + 1)
    earlier, later = repeated_windows(text, starts, length)
    assert earlier.tolist() == (lpf(text, length)[starts] >= length).tolist()
    assert later[::1].sum() > 0
    raw = text.tobytes()
    assert later.tolist() == [raw.find(raw[i:i + length], i + 1) >= 0 for i in starts]


def test_anchors_deal_every_window_once():
    r = np.random.default_rng(5)
    lens = [0, 10, 200, 201, 3000, 50, 777]
    data = r.integers(0, 4, sum(lens)).astype(np.uint8)
    found = anchors(data, np.cumsum([0] + lens), 200, 64)
    windows = Counter((d, s + i) for d, s, n in zip(found["doc"], found["start"], found["n"]) for i in range(n))
    assert set(windows.values()) == {1}
    assert len(windows) == sum(max(0, n - 199) for n in lens)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("class_slices", [2000, 1])
def test_against_brute_force(spark, keep_first, class_slices, monkeypatch):
    monkeypatch.setattr(repeats.repeated_spans, "__defaults__", (200, 64, False, class_slices))
    rows = near_copies(1)
    texts = [(i, t.encode()) for i, t, _ in rows]
    want = {i: summary(t, m) for (i, t), m in zip(texts, brute(texts, 200, keep_first))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(docs_of(spark, rows), 200, keep_first).collect()}
    assert got == want
    assert sum(w[1] for w in want.values()) > 1000


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 1000)
    t = near_copies(3, 3)[0][1] * 8
    data = np.frombuffer(t.encode(), np.uint8)
    assert len(data) > 3000
    whole = brute([(0, t.encode())], 200)[0]
    got = remove_repeats(docs_of(spark, [(0, t, None)]), 200, False).first()
    assert (got.n_removed, got.n_spans) == summary(t.encode(), whole)[1:3]


def test_odd_rows(spark):
    long = "x".join(str(i) for i in range(200))
    rows = ODD_ROWS + [(20, long, None), (20, long, None), (None, long, None)]
    got = remove_repeats(docs_of(spark, rows), 200, False).collect()
    assert len(got) == len(rows)
    assert all(r.n_removed == (r.n_bytes if r.text == long else 0) for r in got)
    first = remove_repeats(docs_of(spark, rows), 200, True).collect()
    assert {(r.doc_id, r.n_removed > 0) for r in first if r.text == long} == {(None, False), (20, True)}
    assert remove_repeats(docs_of(spark, [])).collect() == []


def test_query(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = sorted((d, *summary(t, m)) for (d, t), m in zip(docs, brute(docs, 200)))
    got = sorted(tuple(r) for r in op7_suffix_repeats(spark, SF001).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == [(*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in want]
