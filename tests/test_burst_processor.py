"""The burst detector as a state processor: parity with the batch form over micro-batches, and going on from the state of a
stopped query with another number of state partitions."""

import os
import random
from datetime import timedelta

import pytest
from conftest import BASE, SF001
from test_streaming import run, write_events

from cartwheel.operators.bursts import suspicious_frequency_alerts
from cartwheel.sources.feeds import event_feed_from
from cartwheel.streaming.bursts import burst_state, last_watermark_ms, suspicious_frequency_processor
from cartwheel.streaming.sources import order_stream_from_files, with_event_time


def rows_of(files: int, seed: int) -> list[list[tuple]]:
    """Files in the order of time; equal times, events without a customer and one hot customer among them."""
    rnd, out, eid = random.Random(seed), [], 0
    for f in range(files):
        out.append([])
        for _ in range(120):
            eid += 1
            out[-1].append((eid, f * 1800 + 20 * rnd.randint(0, 89), rnd.choice([1, 1, 1, 2, 3, None]), "click", 10.0))
    return out


def written(spark, folder, files, first=0):
    os.makedirs(folder, exist_ok=True)
    for f, rows in enumerate(files, first):
        write_events(spark, folder, f"{f}-events.parquet", rows, 1_000_000 + f * 1000)
    return order_stream_from_files(spark, folder, "*-events.parquet", 1)


def stream(orders, **more):
    return suspicious_frequency_processor(with_event_time(orders), 3, "5 minutes", **more)


def alerts(df):
    return sorted((r.entity_id, r.detected_at, r.description) for r in df.collect())


def expected(spark, folders, until):
    """Of the batch form, over all events that were not late, up to the last watermark."""
    batch = spark.read.parquet(*folders)
    return [a for a in alerts(suspicious_frequency_alerts(event_feed_from(batch), 3, "5 minutes")) if a[1] <= until]


def test_matches_batch_over_batches(spark, tmp_path):
    files = rows_of(4, 5)
    src = str(tmp_path / "src")
    orders = written(spark, src, files)
    got = alerts(run(spark, stream(orders), "alert", str(tmp_path / "out"), str(tmp_path / "ckpt"), "processor_t"))
    wm = BASE + timedelta(seconds=max(r[1] for f in files for r in f) - 10)
    want = expected(spark, [src], wm)
    assert want and got == want
    # late rows of a customer with a burst change nothing, and the same checkpoint goes on
    written(spark, src, [[(9000 + i, 60, 1, "click", 1.0) for i in range(5)]], first=4)
    orders = order_stream_from_files(spark, src, "*-events.parquet", 1)
    assert alerts(run(spark, stream(orders), "alert", str(tmp_path / "out"), str(tmp_path / "ckpt"), "processor_t2")) == want


def test_no_events_no_alerts(spark, tmp_path):
    orders = written(spark, str(tmp_path / "src"), [[(1, 0, None, "click", 1.0)]])
    assert alerts(run(spark, stream(orders), "alert", str(tmp_path / "out"), str(tmp_path / "ckpt"), "processor_e")) == []


@pytest.mark.parametrize("partitions", [3, 13])
def test_goes_on_with_other_partitions(spark, tmp_path, partitions):
    """A burst spans the stop: pending and judged times come from the state of the stopped query, its watermark too."""
    files = rows_of(4, 6)
    files[1] += [(800 + i, 3590 + i, 1, "click", 1.0) for i in range(9)]         # not yet behind the watermark at the stop
    files[2] += [(900 + i, 3600 + i, 1, "click", 1.0) for i in range(3)]
    files[2] += [(950, 30, 1, "click", 1.0)]                                     # late for the stopped query, so for the new one
    early, late = str(tmp_path / "early"), str(tmp_path / "late")
    ckpt = [str(tmp_path / "ckpt0"), str(tmp_path / "ckpt1")]
    got = alerts(run(spark, stream(written(spark, early, files[:2])), "alert", str(tmp_path / "out0"), ckpt[0], f"stopped_{partitions}"))
    pending = burst_state(spark, ckpt[0]).where("kind = 'pending'").count()
    assert pending >= 9 and last_watermark_ms(spark, ckpt[0]) == int((3598 - 10) * 1000 + (BASE - type(BASE)(1970, 1, 1)).total_seconds() * 1000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        result = stream(written(spark, late, files[2:], first=2), restore=ckpt[0])
        got += alerts(run(spark, result, "alert", str(tmp_path / "out1"), ckpt[1], f"restored_{partitions}"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    meta = [{r.numPartitions for r in spark.read.format("state-metadata").load(c).collect()} for c in ckpt]
    assert meta == [{int(before)}, {partitions}]
    on_time, wm = str(tmp_path / "on_time"), BASE + timedelta(seconds=max(r[1] for f in files for r in f) - 10)
    files[2] = [r for r in files[2] if r[0] != 950]
    written(spark, on_time, files)
    want = expected(spark, [on_time], wm)
    assert len(want) > 30 and sorted(got) == want


@pytest.mark.parametrize("name", ["bursts_stream_processor", "bursts_stream_restored"])
def test_queries_bring_their_state_store(spark, name):
    """The driver's session has Spark's default state store, which can't hold a processor's state; it is as before afterwards."""
    from cartwheel.plans.queries import QUERIES
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, default)
    try:
        got = QUERIES[name](spark, SF001)
        assert spark.conf.get(key) == default
        want = QUERIES["suspicious_frequency_alerts_1d_event"](spark, SF001)
        assert got.count() and sorted(got.collect()) == sorted(want.collect())
    finally:
        spark.conf.set(key, before)
