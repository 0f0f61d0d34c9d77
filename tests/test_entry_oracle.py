"""Every registered query against its DuckDB formulation, on the smallest driver tables."""

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as entry_mod
from cartwheel.plans.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


def normalise(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
        df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["product_category", "total_revenue", "order_count", "window_start", "window_end"]
    assert df.count() > 0


def test_registry_has_oracles():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) - set(o) == {"stream_rates_per_second"}      # depends on the clock


@pytest.mark.parametrize("name", sorted(set(entry_mod.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    got = entry_mod.queries()[name](spark, SF001).toPandas()
    want = duck.sql(entry_mod.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert normalise(got).equals(normalise(want))


def test_stream_metrics_rows(spark):
    from cartwheel.plans.queries import _metric_replays
    rows = _metric_replays(spark, SF001).collect()
    names = {(r.query, r.name) for r in rows}
    assert ("revenue", "windowsEmitted") in names and ("kpi", "lastWindowOrderCount") in names
    assert ("alerts", "suspiciousFrequencyAlertsEmitted") in names and ("alerts", "deserializationErrors") in names
    assert {("revenue", "recordsOutPerSecond"), ("kpi", "inputRowsPerSecond")} <= names
    total = {}
    for r in rows:
        total[(r.query, r.name)] = total.get((r.query, r.name), 0) + r.value
    q = entry_mod.queries()
    assert total[("revenue", "windowsEmitted")] == q["revenue_by_category_1m"](spark, SF001).count()
