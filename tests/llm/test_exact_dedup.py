import pytest
from helpers import ODD_ROWS

from cartwheel.llm import exact_dedup as module
from cartwheel.llm.exact_dedup import exact_dedup, run_state

ROWS = ODD_ROWS + [(30, "a b c", None), (31, "a  b c", None), (32, "abc", None), (29, "a  b c", None)]


def write(spark, path, rows, files=3):
    spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(files).write.mode("append").parquet(path)


def test_one_row_of_each_group_stays(spark, tmp_path):
    path = f"{tmp_path}/docs"
    write(spark, path, ROWS)
    got = exact_dedup(spark, path, columns=("text",)).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r)
    assert all(sum(r.kept for r in g) == 1 and {r.group_size for r in g} == {len(g)} for g in groups.values())
    abc = {r.doc_id: (r.keep_id, r.kept) for r in got if r.doc_id in (29, 30, 31, 32)}
    assert abc == {29: (29, True), 30: (29, False), 31: (29, False), 32: (29, False)}
    assert [r.keep_id for r in got if r.doc_id is None] == [None]
    assert {r.keep_id for r in got if r.doc_id in (2, 3, 4)} == {4}      # the blank text has the most code points


def test_state_goes_on_after_a_stop(spark, tmp_path):
    path, checkpoint = f"{tmp_path}/docs", f"{tmp_path}/checkpoint"
    write(spark, path, ROWS)
    before = {r.digest: r.n for r in run_state(spark, path, checkpoint).collect()}
    write(spark, path, [(1000, "a b  c !", None), (28, "a  b c", None)], 1)
    after = {r.digest: (r.n, -r.best.id if r.best.id is not None else None) for r in run_state(spark, path, checkpoint).collect()}
    assert sum(before.values()) == len(ROWS) and sum(n for n, _ in after.values()) == len(ROWS) + 2
    assert (5, 28) in after.values()


def test_equal_digests_of_different_bytes(spark, tmp_path, monkeypatch):
    """A digest that collides: the check on full bytes tells the texts apart."""
    path = f"{tmp_path}/docs"
    write(spark, path, ROWS + [(40, "c b a", None), (41, "c b  a", None)])
    real = module.F.sha2
    monkeypatch.setattr(module.F, "sha2", lambda column, bits: module.F.length(column).cast("string"))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(spark, path).collect()}
    monkeypatch.setattr(module.F, "sha2", real)
    assert got[40] == (41, 2, False) and got[41] == (41, 2, True)
    assert got[29] == (29, 4, True) and got[32] == (29, 4, False)
    assert got[5] == (5, 1, True)


def test_no_rows_and_one_file(spark, tmp_path):
    write(spark, f"{tmp_path}/none", [], 1)
    assert exact_dedup(spark, f"{tmp_path}/none").collect() == []
    write(spark, f"{tmp_path}/one", ROWS, 1)
    file = next(f for f in (tmp_path / "one").iterdir() if f.suffix == ".parquet")
    assert len(exact_dedup(spark, str(file)).collect()) == len(ROWS)


def test_clashing_columns_and_long_texts(spark, tmp_path):
    long = "word " * 400_000
    write(spark, f"{tmp_path}/long", [(1, long, "x"), (2, long + " ", "y"), (3, long + "z", "x")], 1)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup(spark, f"{tmp_path}/long").collect()) == [(1, 2, 2), (2, 2, 2), (3, 3, 1)]
    with pytest.raises(ValueError):
        exact_dedup(spark, f"{tmp_path}/long", columns=("digest",))
