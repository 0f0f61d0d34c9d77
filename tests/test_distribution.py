from datetime import timedelta
from decimal import Decimal

from conftest import BASE

from cartwheel.operators.distribution import kpi_value_distribution


def dist(spark, values, capacity=10):
    rows = [(BASE + timedelta(minutes=i), Decimal(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "window_start timestamp, average_order_value decimal(12,2)")
    return kpi_value_distribution(df, capacity).first()


def test_empty(spark):
    d = dist(spark, [])
    assert (d["count"], d["size"], d["min"], d["max"], d["mean"], d["p50"]) == (0, 0, 0, 0, 0.0, 0.0)


def test_count_and_stats(spark):
    assert dist(spark, ["100", "200"])["count"] == 2
    d = dist(spark, ["100", "200", "300"])
    assert (d["size"], d["min"], d["max"], d["mean"]) == (3, 100, 300, 200.0)


def test_p50_nearest_rank(spark):
    assert dist(spark, ["10", "20", "30", "40", "50"])["p50"] == 30.0


def test_eviction_keeps_last_capacity(spark):
    d = dist(spark, ["1", "2", "3", "100"], capacity=3)
    assert (d["count"], d["size"], d["max"], d["min"]) == (4, 3, 100, 2)


def test_stddev(spark):
    assert dist(spark, ["42"])["stddev"] == 0.0
    assert abs(dist(spark, ["2", "4", "4", "4", "5", "5", "7", "9"])["stddev"] - 2.0) < 1e-9


def test_window_averages_round_half_up(spark):
    d = dist(spark, ["2.50", "2.49"])
    assert (d["min"], d["max"]) == (2, 3)
