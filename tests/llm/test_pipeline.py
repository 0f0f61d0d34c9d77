import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from conftest_paths import SF01
from cartwheel.llm.decontamination import Phrases, shard_hits
from cartwheel.llm.pieces import Vocabulary, default_model
from helpers import ODD_ROWS
from test_near_dups import brute_of

COLUMNS = corpus_pipeline.COLUMNS


def test_stages(spark):
    """Each stage against a plain check on its own input."""
    read = lambda t: spark.read.parquet(f"{SF01}/{t}.parquet")
    docs = read("documents")
    ins, outs = [], []
    for name, stage in corpus_pipeline.STAGES:
        ins.append({r.doc_id: r for r in docs.collect()})
        docs = corpus_pipeline.saved(stage(spark, docs, SF01), "test-stage")
        outs.append({r.doc_id: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "SentencePiece encoding"]
    toxic = {r.doc_id: r.toxic for r in read("labels").collect()}
    gone = set(ins[0]) - set(outs[0])
    assert gone and sum(toxic.get(d, 1) for d in gone) >= 0.9 * len(gone)
    # exact copies: one document for each text without white space
    keys = [("".join((r.text or "").split(" ")).translate({i: None for i in range(9, 14)}), -len(r.text or ""), d) for d, r in ins[1].items()]
    best = {}
    for k, n, d in keys:
        best[k] = min(best.get(k, (0, 1 << 60)), (n, d))
    assert set(outs[1]) == {d for _, d in best.values()}
    components = brute_of([(d, r.text) for d, r in ins[2].items()], 5, 80)
    assert set(outs[2]) == {d for d, (_, c) in components.items() if c == d}
    phrases = Phrases([(str(r.item_id), r.text) for r in read("benchmark").collect()], 10)
    ids = sorted(ins[3])
    hits = {d for d, (_, spans, _) in zip(ids, shard_hits([ins[3][d].text for d in ids], phrases)) if spans}
    assert hits and all(outs[3][d].text == ins[3][d].text for d in ids if d not in hits)
    left = [d for d in hits if d in outs[3]]
    assert not any(x[1] for x in shard_hits([outs[3][d].text for d in left], phrases))
    assert all(r.n_chars == len(r.text) for d, r in outs[3].items() if d in hits)
    with open(default_model(), "rb") as f:
        vocabulary = Vocabulary(f.read())
    assert set(outs[4]) == set(outs[3])
    assert all(vocabulary.decode(r.ids) == (outs[3][d].text or "") for d, r in outs[4].items())


def test_odd_rows_and_no_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    for name, rows in (("some", ODD_ROWS), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame([(d, t, "en", "s", 0, None) for d, t, _ in rows], schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in got} == ({1, 4, 5, 6, None} if rows else set())


def test_entry_without_the_folder(tmp_path):
    """The other queries import and run when the subpackage and the pipeline are gone."""
    repo = Path(__file__).resolve().parents[2]
    for p in repo.iterdir():
        if p.name not in ("cartwheel", "corpus_pipeline.py", "tests", ".git"):
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "cartwheel").mkdir()
    for p in (repo / "cartwheel").iterdir():
        if p.name != "llm":
            (tmp_path / "cartwheel" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    got = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {str(tmp_path)!r}); {code}"], capture_output=True, text=True, cwd=tmp_path,
                         env={"PATH": "/usr/bin:/bin", "HOME": "/tmp"})
    assert got.stdout.split()[1:] == ["False", "False", "True"], got.stderr
