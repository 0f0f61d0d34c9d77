"""Queries with SQL against DuckDB, on the given tables and on odd rows."""

import duckdb
import pandas as pd
import pytest
from conftest_paths import SF001
from helpers import ODD_ROWS, TABLES, long_text

from cartwheel.llm.queries import ORACLE, QUERIES


def same(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'' if folder == SF001 else '/*.parquet'}')")
    want = con.sql(ORACLE[name]).df()
    got = QUERIES[name](spark, folder).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)

    def key(df):
        plain = lambda v: "" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v)
        return sorted(tuple(plain(v) for v in row) for row in df[columns].astype(object).itertuples(index=False))

    assert key(got) == key(want)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_given_tables(spark, name):
    same(spark, SF001, name)


ITEM = "one two three four five six seven eight nine ten eleven twelve"
HIT_ROWS = ODD_ROWS + [
    (10, f"before {ITEM} after", None), (11, ITEM.upper().replace(" ", "--"), None), (12, ITEM + " " + ITEM, None),
    (13, "one two three four five six seven eight nine", None), (14, "just three words and just three words", None),
    (15, " ".join([ITEM] * 500), None), (16, "two three four five six seven eight nine ten eleven", None), (17, long_text(1, 5000), None)]
ITEMS = [(1, ITEM), (2, "just three words"), (3, None), (4, ""), (5, ITEM), (5, ITEM), (6, " ".join(["again"] * 12)), (7, "zzz"), (10, "word")]


@pytest.mark.parametrize("name", ["op10_decontamination", "op6_exact_dedup"])     # near duplicates: their own brute force
@pytest.mark.parametrize("rows", [HIT_ROWS, []])
def test_odd_rows(spark, tmp_path, name, rows):
    spark.createDataFrame(rows, "doc_id long, text string, n_words string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for t in ("pages", "labels"):
        spark.range(1).write.parquet(f"{tmp_path}/{t}.parquet")
    same(spark, str(tmp_path), name)
