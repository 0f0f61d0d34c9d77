import zlib

import pytest
from conftest_paths import SF001
from helpers import ODD_ROWS

from cartwheel.llm.sharding import op5_sharding, shard_by_bytes


def brute(rows, shards):
    """(key, size) rows in order -> shard of each, slots."""
    total, before, out = sum(s for _, s in rows), 0, []
    count = {}
    for i, (key, size) in enumerate(rows):
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total)) if total else i * shards // len(rows)
        out.append((key, shard, count.get(shard, 0)))
        count[shard] = count.get(shard, 0) + 1
        before += size
    return out


@pytest.mark.parametrize("sizes", [[5] * 100, [1, 1000, 1, 1, 500, 2] * 7, [0] * 30, [10 ** 12, 1, 1], [7]])
def test_against_running_sums(spark, sizes):
    rows = [(i, s, "a") for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "id long, size long, shard0 string").repartition(5)
    got = sorted((r.id, r.shard, r.slot) for r in shard_by_bytes(df, "size", ["id"], 4).collect())
    assert got == brute([(i, s) for i, s, _ in rows], 4)


def test_no_rows_nulls_and_equal_rows(spark):
    empty = spark.createDataFrame([], "id long, size long")
    assert shard_by_bytes(empty, "size", ["id"], 4).collect() == []
    df = spark.createDataFrame([(1, None), (1, None), (None, 4), (2, 4), (2, 4)], "id long, size long")
    rows = shard_by_bytes(df, "size", ["id"], 2).collect()
    assert sorted((r.id or 0, r.shard) for r in rows) == [(0, 0), (1, 0), (1, 0), (2, 1), (2, 1)]
    for shard in (0, 1):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_query_on_documents(spark):
    got = op5_sharding(spark, SF001).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas().sort_values("doc_id")
    raw = [(t or "").encode() for t in docs.text]
    assert got.text_crc32.tolist() == [zlib.crc32(t) for t in raw]
    assert got["size"].tolist() == [len(t) + 8 for t in raw]
    want = brute(list(zip(docs.doc_id, (len(t) + 8 for t in raw))), 24)
    assert list(zip(got.doc_id, got.shard, got.slot)) == want
    assert set(got.law) == {"bytes"} and got.grown_shard.isna().all()


def test_query_on_odd_rows(spark, tmp_path):
    spark.createDataFrame(ODD_ROWS, "doc_id long, text string, law string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = op5_sharding(spark, str(tmp_path)).collect()
    assert len(rows) == len(ODD_ROWS)
    assert {r.shard for r in rows} <= set(range(24))


def test_clashing_names_are_refused(spark):
    for name in ("shard", "SLOT", "_row"):
        with pytest.raises(ValueError):
            shard_by_bytes(spark.createDataFrame([(1, 2, 3)], f"id long, size long, `{name}` long"), "size", ["id"], 4)


def test_a_row_larger_than_a_shard(spark):
    rows = [(i, 10_000_000 if i == 7 else 5) for i in range(20)]
    got = sorted((r.id, r.shard, r.slot) for r in shard_by_bytes(spark.createDataFrame(rows, "id long, size long"), "size", ["id"], 4).collect())
    assert got == brute(rows, 4)
