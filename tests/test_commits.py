"""Exactly-once output: what is left by a driver that dies at any point, and runs with other sinks."""
import os

import pytest
from conftest import SF001
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.sinks import commits
from cartwheel.sinks.commits import append_once, last_committed, read_committed, write_committed
from cartwheel.sinks.tables import create_result_tables, to_revenue_rows
from cartwheel.operators.revenue import revenue_by_category
from cartwheel.sources.feeds import event_feed
from cartwheel.streaming.jobs import Sink, revenue_stream, start_all
from cartwheel.streaming.sources import order_stream_from_files


class Died(Exception):
    pass


def dying(real, after):
    """The function, which works ``after`` times and then dies ahead of its work."""
    calls = []

    def run(*args, **kwargs):
        calls.append(1)
        if len(calls) > after:
            raise Died()
        return real(*args, **kwargs)
    return run


def rows_of(df):
    return sorted(map(str, (tuple(r[c] for c in ("product_category", "window_start", "order_count")) for r in df.collect())))


@pytest.fixture
def revenue(spark):
    return to_revenue_rows(revenue_by_category(event_feed(spark, SF001)), True).repartition(3)


@pytest.mark.parametrize("step, after", [("publish", 0), ("_system", 6), ("_system", 9), ("_system", 12), ("_system", 20), ("_described", 0)])
def test_table_append_after_a_death(spark, tmp_path, monkeypatch, revenue, step, after):
    """Dies ahead of the renames, between them, or ahead of the last mark; then runs again, twice."""
    table = create_result_tables(spark, f"commit_{step.strip('_')}_{after}", "parquet", str(tmp_path / "wh"))[0]
    append_once(revenue.limit(5), table, str(tmp_path / "staged" / "0"), "q-0")
    before = rows_of(spark.table(table))
    with monkeypatch.context() as m:
        m.setattr(commits, step, dying(getattr(commits, step), after))
        try:
            append_once(revenue, table, str(tmp_path / "staged" / "1"), "q-1")
        except Died:
            pass
    for _ in range(2):
        append_once(revenue, table, str(tmp_path / "staged" / "1"), "q-1")
        assert rows_of(spark.table(table)) == sorted(before + rows_of(revenue))


@pytest.mark.parametrize("after", [0, 1])
def test_folder_shows_whole_batches_only(spark, tmp_path, monkeypatch, revenue, after):
    folder = str(tmp_path / "out")
    assert read_committed(spark, folder, revenue.schema).collect() == []
    write_committed(revenue.limit(7), folder, 0)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", dying(commits.commit, 0))
        with pytest.raises(Died):
            write_committed(revenue, folder, 1)
    assert read_committed(spark, folder, revenue.schema).count() == 7      # its files are there, its entry is not
    for _ in range(1 + after):
        write_committed(revenue, folder, 1)
    assert read_committed(spark, folder, revenue.schema).count() == 7 + revenue.count() and last_committed(spark, folder) == 1
    write_committed(revenue.limit(1), folder, 2)
    assert sorted(n for n in os.listdir(f"{folder}/_commits") if n.isdigit()) == ["1", "2"]


def test_number_of_sinks_may_change(spark, tmp_path):
    """One Parquet sink, then a Parquet sink and a table, then one again, on one checkpoint: every row is in the folder once."""
    table = create_result_tables(spark, "commit_switch", "parquet", str(tmp_path / "wh"))[0]
    source, folder, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    parts = F.ntile(3).over(Window.orderBy("ts"))
    events = events.withColumn("part", parts)
    seen = []
    for k in (1, 2, 3):
        events.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(str(source))
        sinks = [Sink("parquet", folder, checkpoint, {"availableNow": True})] + [Sink("table", table, checkpoint)] * (k == 2)
        result = revenue_stream(order_stream_from_files(spark, str(source)))
        q = start_all(result, "revenue", sinks, f"switch_{k}")
        q.awaitTermination()
        assert q.exception() is None
        seen.append(read_committed(spark, folder, result.schema).count())
    rows = rows_of(read_committed(spark, folder, result.schema))
    assert seen[0] < seen[1] < seen[2] == len(rows) == len(set(rows))
    assert spark.table(table).count() == seen[1] - seen[0]
    whole = rows_of(revenue_by_category(event_feed(spark, SF001)))
    assert set(rows) <= set(whole) and len(rows) > 0.9 * len(whole)        # but for the windows still open


def test_other_layouts_are_refused(spark, tmp_path, revenue):
    folder = tmp_path / "old"
    (folder / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError):
        write_committed(revenue, str(folder), 0)
