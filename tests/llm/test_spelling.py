import random
import re
import zlib
from collections import Counter

from conftest_paths import SF001
from helpers import ODD_ROWS, docs_of

from cartwheel.llm import spelling
from cartwheel.llm.queries import QUERIES
from cartwheel.llm.spelling import spelling_variants, word_counts

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return any(y[:k] + y[k + 1:] == x for k in range(len(y)))


def brute(words):
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return out


def rows_of(df):
    rows = df.select(*COLUMNS).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def made(seed, n, letters="abcé\U0001F600", longest=9):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(1, longest))): r.choice([1, 2, 3, 4, 8, 8, 16, 100]) for _ in range(n)}


def check(spark, words):
    assert rows_of(spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def test_dense_words(spark):
    check(spark, made(1, 700, "ab"))
    check(spark, made(2, 500))
    check(spark, {w: 5 for w in made(3, 300, "abc", 6)})        # ties


def test_large_groups_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 16)
    monkeypatch.setattr(spelling, "PAIR_CHARS", 500)
    check(spark, {"same" + w: n for w, n in made(4, 400, "abcd", 5).items()})


def test_long_words_and_chains(spark):
    long = "x" * 5000
    words = {long: 3, long + "y": 9, "z" + long + "y": 27, "aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 33, "other": 2}
    check(spark, words)


def test_empty_null_and_other_columns(spark):
    frame = spark.createDataFrame([("abcde", 3, 1, "k"), ("abcdf", 9, 2, "k"), (None, 7, 3, "k")], "word string, n long, size int, key string")
    assert rows_of(spelling_variants(frame)) == brute({"abcde": 3, "abcdf": 9})
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_counts(spark):
    rows = ODD_ROWS * 3 + [(n, "Straße ÉCLAIR éclair Éclair×÷ again" * 7, "z") for n in range(60)] + [(9, "w" * 30_000 + " ", "z")] * 3
    got = {r.word: r.n for r in word_counts(docs_of(spark, rows)).collect()}
    assert got == brute_counts([r[:2] for r in rows])
    assert word_counts(docs_of(spark, [])).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    words = brute_counts(rows)
    got = rows_of(QUERIES["op12_spelling_variants"](spark, SF001))
    assert {(r[0], r[3]) for r in got} == set(words.items())
    near = {w: set() for w in words}        # by deletions, as all pairs are too many here
    by_cut = {}
    for w in words:
        for k in range(len(w)):
            cut = w[:k] + w[k + 1:]
            by_cut.setdefault((k, cut), set()).add(w)
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    for own in by_cut.values():
        for w in own:
            near[w] |= own - {w}
    assert {(r[0], r[4]) for r in got} == {(w, len(own)) for w, own in near.items()}
    form = {r[0]: r[1] for r in got}
    for word, own, root, n, _, form_n in got:
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        assert own == (best if best and words[best] >= 2 * n else None) and form_n == (words[own] if own else None)
        assert root == (form_root(form, word))


def form_root(form, word):
    while form[word]:
        word = form[word]
    return word
