import random
import re

import numpy as np
import pytest
from conftest_paths import SF001
from helpers import ODD_ROWS, docs_of

from cartwheel.llm import near_dups
from cartwheel.llm.near_dups import components, near_duplicates, op9_near_duplicates

UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    """doc_id -> (set size, component) for distinct doc_ids."""
    sets = {}
    for d, t, *_ in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets[d] = set(zip(w, w[1:])) if len(w) > 1 else {(x,) for x in w}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def family(seed, n, drift):
    """Documents that change a little from one to the next: chains of links."""
    r = random.Random(seed)
    words = [f"w{r.randrange(3000)}" for _ in range(60)]
    out = []
    for _ in range(n):
        words = list(words)
        for _ in range(drift):
            words[r.randrange(len(words))] = f"w{r.randrange(3000)}"
        out.append(" ".join(words))
    return out


def check(got, want):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)


@pytest.mark.parametrize("small, depth", [(64, 6), (3, 6), (2, 1)])
def test_against_brute_force(spark, small, depth, monkeypatch):
    monkeypatch.setattr(near_dups, "DEPTH", depth)
    texts = [t for s in range(6) for t in family(s, 12, 1 + s % 4)] + ["one two", "One  TWO", "one", "two one", "one two three"] * 2
    random.Random(1).shuffle(texts)
    rows = [(i * 3, t, None) for i, t in enumerate(texts)]
    want = brute(rows)
    assert 10 < len({c for _, c in want.values()}) < len(want)
    check(near_duplicates(docs_of(spark, rows), small=small, words=2).collect(), want)


def brute_of(rows, words, percent):
    """The same for any shingles and similarity."""
    sets = {}
    for d, t, *_ in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets[d] = {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    label = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {d: low if c == high else c for d, c in label.items()}
    return {d: (len(sets[d]), label[d]) for d in sets}


@pytest.mark.parametrize("words", [1, 2, 3, 5])
def test_shingles_of_other_lengths(spark, words):
    texts = [t for s in range(4) for t in family(s, 10, 1 + s % 3)] + ["one two", "One  TWO", "one", "a b c d e", "a b c d", "A b c  d", "", None]
    rows = [(i * 3, t, None) for i, t in enumerate(texts)]
    want = brute_of(rows, words, 80)
    assert words != 2 or want == brute(rows)
    assert len({c for _, c in want.values()}) < len(want)
    check(near_duplicates(docs_of(spark, rows), words=words).collect(), want)


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)]
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: c for x, c in root.items() if x != c}


def test_odd_rows(spark):
    got = near_duplicates(docs_of(spark, ODD_ROWS + [(9, "THE SAME text again\nand again", None), (None, "the same text again and again", None)]), words=2).collect()
    assert len(got) == len(ODD_ROWS) + 2
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    assert by[(9, 5)] == (1, False) and by[(1, 5)] == (1, True)
    assert sorted(r.kept for r in got if r.component_id == 1) == [False, False, True, True]
    assert by[(2, 0)] == (2, True) and by[(3, 0)] == (3, True) and by[(4, 0)] == (4, True)
    assert by[(5, 1)] == (5, True)
    assert near_duplicates(docs_of(spark, [])).collect() == []


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_words_that_collide_in_polynomial_hashes(spark):
    x, y = thue_morse(1024), thue_morse(1024, "b", "a")
    rows = [(1, x, None), (2, y, None), (3, f"{x} {y} {x} one two", None), (4, f"{y} {x} {y} one two", None), (5, x.upper(), None)]
    check(near_duplicates(docs_of(spark, rows), words=2).collect(), brute(rows))
    check(near_duplicates(docs_of(spark, rows)).collect(), brute_of(rows, 5, 80))


def test_long_words_and_long_texts(spark):
    r = random.Random(9)
    long = [f"w{r.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(long), None), (2, " ".join(long[:-40] + ["x"]), None), (3, " ".join(long[::-1]), None), (4, "q" * 300_000, None),
            (5, "q" * 300_001, None), (6, "q" * 300_000 + " ", None)]
    got = {d.doc_id: d.component_id for d in near_duplicates(docs_of(spark, rows), words=2).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 4}


def test_word_hashes_depend_on_the_bytes_alone():
    r = random.Random(3)
    words = [bytes(r.choice(b"abc\0") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    start = np.cumsum(sizes + 1) - sizes - 1
    hashes = near_dups.word_hashes(data, start, start + sizes, 0).tolist()
    assert len(dict(zip(words, hashes))) == len(set(words)) == len(set(hashes)) == len(set(zip(words, hashes)))


def test_sets_by_join_and_by_bitmap(spark, monkeypatch):
    rows = [(i * 3, t, None) for i, t in enumerate([t for s in range(3) for t in family(s, 8, 2)])]
    monkeypatch.setattr(near_dups, "ID_BITS", 1)
    check(near_duplicates(docs_of(spark, rows)).collect(), brute_of(rows, 5, 80))


def test_refuses_lower_similarity(spark):
    with pytest.raises(ValueError):
        near_duplicates(docs_of(spark, ODD_ROWS), percent=79)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    check(op9_near_duplicates(spark, SF001).collect(), brute(rows))
