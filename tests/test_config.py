from decimal import Decimal

from cartwheel.config import JobConfig, result_database, table_catalog_settings
from cartwheel.functions.columns import span_microseconds, span_text
from cartwheel.streaming.sources import kafka_source_options


def test_defaults_and_environment():
    d = JobConfig.from_env({})
    assert (d.bootstrap_servers, d.checkpoint_interval_ms, d.table_enabled) == ("localhost:9092", 30000, False)
    assert (d.orders_topic, d.revenue_topic, d.alerts_topic, d.kpi_topic) == (
        "orders", "revenue-by-category", "order-alerts", "realtime-kpis")
    assert (d.suspicious_order_count, d.price_anomaly_threshold) == (3, Decimal("500"))
    assert d.trigger_interval == "30000 milliseconds"
    e = JobConfig.from_env({"ICEBERG_ENABLED": "TRUE", "SUSPICIOUS_ORDER_COUNT": "5",
                            "PRICE_ANOMALY_THRESHOLD": "99.5", "MAX_OFFSETS_PER_TRIGGER": "1000"})
    assert (e.table_enabled, e.suspicious_order_count, e.price_anomaly_threshold) == (True, 5, Decimal("99.5"))
    assert kafka_source_options("b:1", "orders", max_offsets_per_trigger=e.max_offsets_per_trigger) == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "orders", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "1000"}
    assert kafka_source_options("b:1", "orders", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_catalog_settings_take_credentials_from_environment_only():
    s = table_catalog_settings({"MINIO_ENDPOINT": "http://m:9000", "MINIO_ROOT_USER": "u", "MINIO_ROOT_PASSWORD": "p"})
    assert s["spark.sql.catalog.olist_catalog"] == "org.apache.iceberg.spark.SparkCatalog"
    assert s["spark.sql.catalog.olist_catalog.warehouse"] == "s3a://warehouse/"
    assert s["spark.hadoop.fs.s3a.access.key"] == "u"
    assert "spark.hadoop.fs.s3a.access.key" not in table_catalog_settings({})


def test_spans():
    assert span_microseconds("5 minutes") == 300_000_000 and span_microseconds("1 day") == 86_400_000_000
    assert span_text("5 minutes") == "5 minutes" and span_text("1 day") == "1440 minutes"
    assert span_text("1 minute") == "1 minute" and span_text("30 seconds") == "30 seconds"


def test_cluster_settings_scale_with_input():
    from cartwheel.session import cluster_settings
    s = cluster_settings(100 * 1024 ** 4, 1000, 8)
    assert int(s["spark.sql.shuffle.partitions"]) > 100_000
    assert s["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
    small = cluster_settings(10 * 1024 ** 2, 2, 4)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_result_database_carries_the_catalog():
    assert result_database({"ICEBERG_CATALOG_NAME": "lake"}) == "lake.order_results"
    assert result_database({}, "parquet") == "order_results"
    name = next(k for k in table_catalog_settings({"ICEBERG_CATALOG_NAME": "lake"}))
    assert name == "spark.sql.catalog.lake"


def test_session_leaves_the_submitted_settings(monkeypatch):
    """Without arguments neither the master nor the shuffle partitions are set."""
    from pyspark.sql import SparkSession

    from cartwheel import session
    seen = {}

    class Builder:
        sparkContext = property(lambda self: self)

        def __getattr__(self, name):
            def call(*args):
                seen.setdefault(name, []).append(args)
                return self
            return call

    monkeypatch.setattr(SparkSession, "builder", Builder())
    session.build_session()
    assert "master" not in seen and "spark.sql.shuffle.partitions" not in {a[0] for a in seen["config"]}
    session.build_session("local[2]", shuffle_partitions=5)
    assert seen["master"] == [("local[2]",)] and ("spark.sql.shuffle.partitions", "5") in seen["config"]
