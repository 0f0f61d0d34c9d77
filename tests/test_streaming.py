import os
import random
from datetime import timedelta, timezone

import pytest
from conftest import BASE, SF001

from cartwheel.operators.bursts import suspicious_frequency_alerts
from cartwheel.operators.revenue import revenue_by_category
from cartwheel.plans.queries import QUERIES
from cartwheel.sources.feeds import event_feed_from
from cartwheel.streaming.jobs import Sink, alert_stream, quarantine_stream, revenue_stream, start
from cartwheel.streaming.sources import EVENTS_TABLE, order_stream_from_files


def write_events(spark, directory, name, rows, mtime):
    """rows: (event_id, seconds, user_id, event_type, value) -> one Parquet file named ``name``."""
    data = [(i, BASE + timedelta(seconds=s), u, t, v, '{"k": 1}') for i, s, u, t, v in rows]
    tmp = os.path.join(directory, "_staging_" + name)
    spark.createDataFrame(data, EVENTS_TABLE).coalesce(1).write.parquet(tmp)
    [part] = [f for f in os.listdir(tmp) if f.endswith(".parquet")]
    target = os.path.join(directory, name)
    os.link(os.path.join(tmp, part), target)
    os.utime(target, (mtime, mtime))


def run(spark, result, record, out, ckpt, name):
    q = start(result, record, Sink("parquet", out, ckpt, {"availableNow": True}), name)
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.parquet(out)


def test_revenue_stream_late_rows_and_restart(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    os.makedirs(src)
    write_events(spark, src, "a-events.parquet", [(1, 0, 1, "click", 1.0), (2, 30, 1, "click", 2.0),
                                                  (3, 200, 1, "click", 4.0)], 1_000_000)
    stream = lambda: revenue_stream(order_stream_from_files(spark, src, "*events.parquet", 1))
    got = run(spark, stream(), "revenue", out, ckpt, "rev_a")
    assert sorted((r.window_start - BASE).seconds for r in got.collect()) == [0]   # [180,240) still open
    # second file: one late row for the emitted window, and a row that closes [180, 240)
    write_events(spark, src, "b-events.parquet", [(4, 10, 1, "click", 100.0), (5, 400, 1, "click", 8.0)], 2_000_000)
    got = run(spark, stream(), "revenue", out, ckpt, "rev_b")
    rows = sorted(((r.window_start - BASE).seconds, float(r.total_revenue), r.order_count) for r in got.collect())
    assert rows == [(0, 5.0, 2), (180, 5.0, 1)]  # late row dropped, no duplicates after restart


def test_quarantine_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    write_events(spark, src, "events.parquet", [(1, 0, 1, "click", 1.0), (2, 1, 1, "error", 2.0),
                                                (3, 2, 1, "signup", 3.0)], 1_000_000)
    got = run(spark, quarantine_stream(order_stream_from_files(spark, src)), "quarantine",
              str(tmp_path / "out"), str(tmp_path / "ckpt"), "quarantine_t")
    assert sorted((r.order_id, r.quarantined_reason) for r in got.collect()) == [("2", "no category"), ("3", "no price")]


def test_burst_stream_matches_batch_over_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    rnd = random.Random(3)
    all_rows, eid = [], 0
    for f in range(4):   # time-ordered files, several micro-batches
        rows = []
        for _ in range(120):
            eid += 1
            rows.append((eid, f * 1800 + rnd.randint(0, 1799), rnd.choice([1, 1, 1, 2, 3]), "click", 10.0))
        write_events(spark, src, f"{f}-events.parquet", rows, 1_000_000 + f * 1000)
        all_rows += rows
    stream = order_stream_from_files(spark, src, "*-events.parquet", 1)
    got = run(spark, alert_stream(stream, 3, "5 minutes", "1000"), "alert",
              str(tmp_path / "out"), str(tmp_path / "ckpt"), "bursts_t")
    batch_src = event_feed_from(spark.createDataFrame(
        [(i, BASE + timedelta(seconds=s), u, t, v, '{"k": 1}') for i, s, u, t, v in all_rows], EVENTS_TABLE))
    wm = BASE + timedelta(seconds=max(r[1] for r in all_rows) - 10)
    expect = sorted((r.entity_id, r.detected_at, r.description)
                    for r in suspicious_frequency_alerts(batch_src, 3, "5 minutes").collect() if r.detected_at <= wm)
    assert expect and sorted((r.entity_id, r.detected_at, r.description) for r in got.collect()) == expect


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    rows = [(i, i * 7, i % 3, ["click", "view", "error"][i % 3], 1.0 + i) for i in range(60)]
    write_events(spark, src, "events.parquet", rows, 1_000_000)
    got = run(spark, revenue_stream(order_stream_from_files(spark, src)), "revenue",
              str(tmp_path / "out"), str(tmp_path / "ckpt"), "rev_parity")
    wm = BASE + timedelta(seconds=max(r[1] for r in rows) - 10)
    batch = revenue_by_category(event_feed_from(spark.read.parquet(src)))
    expect = sorted(tuple(r) for r in batch.collect() if r.window_end <= wm)
    assert sorted(tuple(r) for r in got.select(*batch.columns).collect()) == expect


def test_enrichment_replay_files_drive_the_jobs(spark, tmp_path):
    """CSV -> time-sorted JSON messages -> revenue, KPI and alert jobs (file source and sink)."""
    from cartwheel.config import JobConfig
    from cartwheel.streaming.run import run_job, write_replay_files
    csv = tmp_path / "csv"
    csv.mkdir()
    (csv / "olist_orders_dataset.csv").write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp\n"
        "o1,c1,delivered,2024-01-01 00:00:10\no2,c1,delivered,2024-01-01 00:00:20\n"
        "o3,c1,delivered,2024-01-01 00:00:30\no4,c2,delivered,2024-01-01 00:05:00\n")
    (csv / "olist_order_items_dataset.csv").write_text(
        "order_id,product_id,seller_id,price,freight_value\n"
        "o1,p1,s1,100.00,1.00\no2,p1,s1,700.00,2.00\no3,p2,s2,5.00,0\n")
    (csv / "olist_products_dataset.csv").write_text("product_id,product_category_name\np1,toys\np2,\n")
    replay, sinks = str(tmp_path / "replay"), str(tmp_path / "sinks")
    write_replay_files(spark, str(csv), replay, files=2)
    cfg = JobConfig()
    for job in ["revenue", "kpi", "alerts"]:
        for q in run_job(spark, job, cfg, source_dir=replay, sink_dir=sinks, trigger={"availableNow": True}):
            q.awaitTermination()
            assert q.exception() is None
    rev = [(r.product_category, float(r.total_revenue), r.order_count)
           for r in spark.read.parquet(f"{sinks}/revenue").collect()]
    assert rev == [("toys", 803.0, 2)]
    assert sorted(r.order_id for r in spark.read.parquet(f"{sinks}/quarantine").collect()) == ["o3", "o4"]
    [kpi] = spark.read.parquet(f"{sinks}/kpi").collect()
    assert (kpi.total_orders, float(kpi.total_revenue), float(kpi.average_order_value)) == (3, 808.0, 269.33)
    alerts = sorted((r.alert_type, r.entity_id) for r in spark.read.parquet(f"{sinks}/alerts").collect())
    assert alerts == [("PRICE_ANOMALY", "s1"), ("SUSPICIOUS_FREQUENCY", "c1")]


def test_late_events_still_give_price_alerts_but_no_bursts(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    os.makedirs(src)
    stream = lambda: alert_stream(order_stream_from_files(spark, src, "*events.parquet", 1), 3, "5 minutes", "100")
    write_events(spark, src, "a-events.parquet", [(1, 1000, 1, "click", 5.0)], 1_000_000)
    run(spark, stream(), "alert", out, ckpt, "late_a")
    # three late events of one customer inside 5 minutes, one of them expensive
    write_events(spark, src, "b-events.parquet", [(2, 10, 2, "click", 500.0), (3, 20, 2, "click", 1.0),
                                                  (4, 30, 2, "click", 1.0)], 2_000_000)
    got = run(spark, stream(), "alert", out, ckpt, "late_b")
    assert sorted((r.alert_type, r.entity_id) for r in got.collect()) == [("PRICE_ANOMALY", "2")]  # seller = event_id % 50


def test_events_without_time_go_to_quarantine_and_do_not_break_bursts(spark, tmp_path):
    src = tmp_path / "msgs"
    src.mkdir()
    (src / "a.txt").write_text("\n".join([
        '{"order_id":"a","customer_id":"c","order_purchase_timestamp":"2024-01-01 00:00:00","product_category":"x","price":1}',
        '{"order_id":"b","customer_id":"c","product_category":"x","price":900}',
        '{"order_id":"c","customer_id":"c","order_purchase_timestamp":"2024-01-01 00:10:00","product_category":"x","price":1}',
    ]) + "\n")
    from cartwheel.streaming.sources import order_stream_from_json_files
    q = run(spark, quarantine_stream(order_stream_from_json_files(spark, str(src))), "quarantine",
            str(tmp_path / "q"), str(tmp_path / "qc"), "q_notime")
    assert [(r.order_id, r.quarantined_reason) for r in q.collect()] == [("b", "no purchase time")]
    a = run(spark, alert_stream(order_stream_from_json_files(spark, str(src)), 2, "5 minutes", "500"), "alert",
            str(tmp_path / "a"), str(tmp_path / "ac"), "a_notime")
    assert sorted((r.alert_type, r.detected_at) for r in a.collect()) == [("PRICE_ANOMALY", None)]


def test_stream_appends_to_result_tables(spark, tmp_path):
    from cartwheel.sinks.tables import create_result_tables, read_revenue
    src = str(tmp_path / "src")
    os.makedirs(src)
    write_events(spark, src, "events.parquet", [(1, 0, 1, "click", 1.0), (2, 86400, 1, "view", 2.0),
                                                (3, 90000, 1, "click", 4.0)], 1_000_000)
    names = create_result_tables(spark, "stream_t", "parquet", str(tmp_path / "wh"))
    events = order_stream_from_files(spark, src)
    for result, record, table in [(revenue_stream(events), "revenue", names[0]),
                                  (alert_stream(events, 3, "5 minutes", "3.5"), "alert", names[2])]:
        q = start(result, record, Sink("table", table, str(tmp_path / f"ck-{record}"), {"availableNow": True}),
                  f"table_{record}")
        q.awaitTermination()
        assert q.exception() is None
    rows = sorted((r.product_category, float(r.total_revenue), str(r.window_date)) for r in spark.table(names[0]).collect())
    assert rows == [("click", 2.0, "2024-01-01"), ("view", 3.0, "2024-01-02")]  # value = price + freight 1
    assert [r.product_category for r in read_revenue(spark, names[0], start=BASE + timedelta(days=1)).collect()] == ["view"]
    assert [(r.alert_type, r.entity_id) for r in spark.table(names[2]).collect()] == [("PRICE_ANOMALY", "3")]


def test_burst_state_survives_restart(spark, tmp_path):
    """A run that starts before a restart and ends after it is still found (state from the checkpoint)."""
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    os.makedirs(src)
    stream = lambda: alert_stream(order_stream_from_files(spark, src, "*events.parquet", 1), 3, "5 minutes", "1000")
    write_events(spark, src, "a-events.parquet", [(1, 0, 7, "click", 1.0), (2, 60, 7, "click", 1.0)], 1_000_000)
    assert run(spark, stream(), "alert", out, ckpt, "restart_a").count() == 0
    write_events(spark, src, "b-events.parquet", [(3, 120, 7, "click", 1.0), (4, 1000, 8, "click", 1.0)], 2_000_000)
    got = run(spark, stream(), "alert", out, ckpt, "restart_b").collect()
    assert [(r.entity_id, (r.detected_at - BASE).seconds, r.description) for r in got] == [
        ("7", 120, "3 orders in less than 5 minutes")]


def test_command_line_enrich(spark, tmp_path):
    from cartwheel.streaming.run import main
    csv = tmp_path / "csv"
    csv.mkdir()
    (csv / "olist_orders_dataset.csv").write_text("order_id,customer_id,order_status,order_purchase_timestamp\n"
                                                  "o1,c1,delivered,2024-01-01 00:00:10\n")
    (csv / "olist_order_items_dataset.csv").write_text("order_id,product_id,seller_id,price,freight_value\n"
                                                       "o1,p1,s1,1.00,2.00\n")
    (csv / "olist_products_dataset.csv").write_text("product_id,product_category_name\np1,toys\n")
    main(["enrich", str(csv), str(tmp_path / "replay")])
    [line] = [r.value for r in spark.read.text(str(tmp_path / "replay")).collect()]
    assert line.startswith('{"order_id":"o1","customer_id":"c1"') and '"totalValue":3.00' in line


def test_command_line_init_tables(spark, tmp_path, capsys):
    from cartwheel.streaming.run import main
    main(["init-tables", "--location", str(tmp_path / "wh")])
    assert capsys.readouterr().out.split() == ["order_results.revenue_by_category", "order_results.realtime_kpis",
                                              "order_results.order_alerts"]
    assert [c.name for c in spark.table("order_results.realtime_kpis").schema] == [
        "average_order_value", "orders_per_minute", "total_orders", "total_revenue", "window_start", "window_end"]


def test_replay_files_are_time_ordered_across_files(spark, tmp_path):
    import json

    from cartwheel.streaming.run import write_replay_files
    csv = tmp_path / "csv"
    csv.mkdir()
    orders = ["order_id,customer_id,order_status,order_purchase_timestamp"]
    items = ["order_id,product_id,seller_id,price,freight_value"]
    for i in range(40):   # written out of time order
        t = (i * 7919) % 3600
        orders.append(f"o{i},c{i % 3},delivered,2024-01-01 {t // 3600:02d}:{t % 3600 // 60:02d}:{t % 60:02d}")
        items.append(f"o{i},p{i % 5},s1,{i}.00,1.00")
    (csv / "olist_orders_dataset.csv").write_text("\n".join(orders) + "\n")
    (csv / "olist_order_items_dataset.csv").write_text("\n".join(items) + "\n")
    (csv / "olist_products_dataset.csv").write_text("product_id,product_category_name\np1,toys\n")
    out = tmp_path / "replay"
    write_replay_files(spark, str(csv), str(out), files=4)
    times = []
    for f in sorted(p for p in out.iterdir() if p.name.startswith("part-")):
        times += [json.loads(line)["order_purchase_timestamp"] for line in f.read_text().splitlines()]
    assert len(times) == 40 and times == sorted(times)


def test_kpi_stream_drops_late_rows(spark, tmp_path):
    from cartwheel.streaming.jobs import kpi_stream
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    os.makedirs(src)
    stream = lambda: kpi_stream(order_stream_from_files(spark, src, "*events.parquet", 1))
    write_events(spark, src, "a-events.parquet", [(1, 0, 1, "click", 1.0), (2, 200, 1, "click", 3.0)], 1_000_000)
    run(spark, stream(), "kpi", out, ckpt, "kpi_a")
    write_events(spark, src, "b-events.parquet", [(3, 5, 1, "click", 50.0), (4, 400, 1, "click", 1.0)], 2_000_000)
    rows = sorted(((r.window_start - BASE).seconds, r.total_orders, float(r.total_revenue))
                  for r in run(spark, stream(), "kpi", out, ckpt, "kpi_b").collect())
    assert rows == [(0, 1, 2.0), (180, 1, 4.0)]   # late row at +5 s dropped; value = price + freight 1


def test_late_rows_are_metric_rows(spark, tmp_path):
    from cartwheel.streaming.metrics import MetricsLog, lateness, metrics_frame
    log = MetricsLog(spark)
    spark.streams.addListener(log)
    try:
        src = tmp_path / "src"
        src.mkdir()
        # file by file; a batch drops what is behind the watermark of the batch before it
        write_events(spark, str(src), "a-events.parquet", [(1, 0, 1, "click", 1.0), (2, 200, 1, "click", 4.0)], 1_000_000)    # 190 s
        write_events(spark, str(src), "b-events.parquet", [(3, 400, 1, "click", 8.0)], 2_000_000)                             # 390 s
        write_events(spark, str(src), "c-events.parquet", [(4, 10, 1, "click", 9.0), (5, 20, 2, "click", 9.0), (6, 70, 2, "click", 9.0),
                                                           (7, 195, 1, "click", 1.0)], 3_000_000)     # three late events in two groups
        write_events(spark, str(src), "d-events.parquet", [(8, 190, 1, "click", 9.0)], 4_000_000)     # one more
        out = str(tmp_path / "out")
        q = start(revenue_stream(order_stream_from_files(spark, str(src), None, 1)), "revenue",
                  Sink("parquet", out, str(tmp_path / "ck"), {"availableNow": True}), "late_metrics")
        q.awaitTermination()
        log.wait_for(q)
        other = start(quarantine_stream(order_stream_from_files(spark, str(src))), "quarantine",
                      Sink("parquet", str(tmp_path / "bad"), str(tmp_path / "ck2"), {"availableNow": True}), "no_state")
        other.awaitTermination()
        log.wait_for(other)
    finally:
        spark.streams.removeListener(log)
    rows = lateness(metrics_frame(spark, log.rows["late_metrics"] + log.rows["no_state"])).collect()
    mark = int(BASE.replace(tzinfo=timezone.utc).timestamp()) + 390
    assert [tuple(r) for r in rows] == [("late_metrics", 3, 2, mark * 1000)]
    assert sorted(float(r.total_revenue) for r in spark.read.parquet(out).collect()) == [2.0, 7.0]   # with a freight of 1 an event
    assert lateness(metrics_frame(spark, [])).collect() == []


STREAM_QUERIES = ["revenue_stream_replay", "kpi_stream_replay", "alerts_stream_replay", "quarantine_stream_replay", "kpi_value_distribution_stream",
                  "stream_metrics", "stream_rates", "stream_lateness"]


@pytest.mark.parametrize("name", STREAM_QUERIES)
def test_replays_read_a_table_of_part_files(spark, tmp_path, name):
    """The same rows from one file and from a folder of part files."""
    spark.read.parquet(f"{SF001}/events.parquet").repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    rows = [sorted(map(str, QUERIES[name](spark, d).collect())) for d in (SF001, str(tmp_path))]
    assert rows[0] and rows[0] == rows[1]


def test_a_source_without_files_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for path in ("empty", "missing"):
        with pytest.raises(FileNotFoundError):
            order_stream_from_files(spark, str(tmp_path / path))


def test_metrics_of_more_batches_than_a_query_remembers(spark, tmp_path):
    from cartwheel.streaming.metrics import MetricsLog, counters, metrics_frame
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    logs = MetricsLog(spark), MetricsLog(spark, str(tmp_path / "metrics"))
    for log in logs:
        spark.streams.addListener(log)
    try:
        src = tmp_path / "src"
        src.mkdir()
        for k in range(6):
            write_events(spark, str(src), f"{k}-events.parquet", [(k, k * 100, 1, "click", 1.0)], 1_000_000 + k)
        q = start(revenue_stream(order_stream_from_files(spark, str(src), None, 1)), "revenue",
                  Sink("parquet", str(tmp_path / "out"), str(tmp_path / "ck"), {"availableNow": True}), "many_batches")
        q.awaitTermination()
        for log in logs:
            log.wait_for(q)
        assert len(q.recentProgress) <= 2
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
        for log in logs:
            spark.streams.removeListener(log)
    kept = metrics_frame(spark, logs[0].rows["many_batches"])
    table = spark.read.parquet(str(tmp_path / "metrics"))
    assert sorted(map(tuple, kept.where("name = 'numInputRows'").collect())) == sorted(map(tuple, table.where("name = 'numInputRows'").collect()))
    assert [r.value for r in counters(kept).where("name = 'windowsEmitted'").collect()] == [5.0]
    assert kept.where("name = 'numInputRows'").agg({"value": "sum"}).first()[0] == 6.0


def test_one_query_writes_files_and_table_and_bounded_jobs_flush(spark, tmp_path, monkeypatch):
    from cartwheel.config import JobConfig
    from cartwheel.sinks.tables import create_result_tables
    from cartwheel.streaming import run as runner
    msgs = tmp_path / "msgs"
    msgs.mkdir()
    line = '{"order_id":"%s","customer_id":"c","seller_id":"s","order_purchase_timestamp":"2024-01-01 00:%02d:00","product_category":%s,"price":%s}'
    (msgs / "a.txt").write_text("\n".join([line % ("a", 0, '"x"', "1.50"), line % ("b", 1, '"x"', "700"), line % ("c", 2, "null", "3")]) + "\n")
    sinks = tmp_path / "sinks"
    names = create_result_tables(spark, "several_t", "parquet", str(tmp_path / "wh"))
    monkeypatch.setattr(runner, "checkpoint_root", lambda spark: str(tmp_path / "ck"))
    for job in ("revenue", "kpi", "alerts"):
        runner.run_bounded(spark, job, JobConfig(table_enabled=True, suspicious_order_count=3), str(msgs), str(sinks), "several_t")
    files = spark.read.parquet(str(sinks / "revenue"))
    assert sorted((r.window_start - BASE).seconds for r in files.collect()) == [0, 60]
    assert sorted(float(r.total_revenue) for r in spark.table(names[0]).collect()) == [1.5, 700.0]
    assert sorted((r.window_start - BASE).seconds for r in spark.table(names[1]).collect()) == [0, 60, 120]
    alerts = sorted((r.alert_type, r.entity_id) for r in spark.table(names[2]).collect())
    assert alerts == sorted((r.alert_type, r.entity_id) for r in spark.read.parquet(str(sinks / "alerts")).collect())
    assert alerts == [("PRICE_ANOMALY", "s"), ("SUSPICIOUS_FREQUENCY", "c")]
    assert [r.order_id for r in spark.read.parquet(str(sinks / "quarantine")).collect()] == ["c"]      # without the end marker
    # the last batch again, as after a failure between the outputs: nothing doubles
    from cartwheel.streaming.jobs import write_batch
    batch = spark.read.parquet(str(sinks / "revenue" / "batch_id=1")) if (sinks / "revenue" / "batch_id=1").exists() else files.drop("batch_id").limit(0)
    before = spark.table(names[0]).count()
    write_batch(batch, "revenue", Sink("table", names[0], str(tmp_path / "ck" / "revenue" / "main")), 1)
    assert spark.table(names[0]).count() == before


def test_topic_jobs_keep_rejected_events_out_of_the_checkpoints(spark, tmp_path, monkeypatch):
    from cartwheel.config import JobConfig
    from cartwheel.streaming import run as runner
    seen = []
    monkeypatch.setattr(runner, "order_source", lambda *a: order_stream_from_files(spark, f"{SF001}/events.parquet"))
    monkeypatch.setattr(runner, "start", lambda result, record, sink, name: seen.append((record, sink)))
    monkeypatch.setattr(runner, "start_all", lambda result, record, sinks, name: seen.append((record, sinks)))
    runner.run_job(spark, "revenue", JobConfig(table_enabled=True), database="d")
    [(_, main), (_, rejected)] = seen
    assert [(s.kind, s.target) for s in main] == [("kafka", "revenue-by-category"), ("table", "d.revenue_by_category")]
    assert (rejected.kind, rejected.target) == ("kafka", "quarantined-orders")


def test_revenue_rows_follow_the_columns_of_their_table(spark, tmp_path):
    from cartwheel.sinks.tables import _ddl
    from cartwheel.schemas import REVENUE_TABLE
    from cartwheel.streaming.jobs import rows_for
    spark.sql("CREATE DATABASE IF NOT EXISTS columns_t")
    spark.sql(f"CREATE TABLE columns_t.plain ({_ddl(REVENUE_TABLE)}) USING parquet LOCATION '{tmp_path}/plain'")
    spark.sql(f"CREATE TABLE columns_t.dated ({_ddl(REVENUE_TABLE)}, window_date date) USING parquet PARTITIONED BY (window_date) LOCATION '{tmp_path}/dated'")
    revenue = revenue_by_category(event_feed_from(spark.read.parquet(f"{SF001}/events.parquet")))
    for table in ("plain", "dated"):
        assert rows_for(revenue, "revenue", Sink("table", f"columns_t.{table}", "")).columns == spark.table(f"columns_t.{table}").columns
