"""Job settings with their defaults, read from the environment like the jobs do."""

from __future__ import annotations

import os
from dataclasses import dataclass
from decimal import Decimal

# Fixed values (defaults of the original job configuration).
DEFAULT_BOOTSTRAP_SERVERS = "localhost:9092"
DEFAULT_CHECKPOINT_INTERVAL_MS = 30000
DEFAULT_ORDERS_TOPIC = "orders"
DEFAULT_REVENUE_TOPIC = "revenue-by-category"
DEFAULT_ALERTS_TOPIC = "order-alerts"
DEFAULT_KPI_TOPIC = "realtime-kpis"
DEFAULT_SUSPICIOUS_ORDER_COUNT = 3
DEFAULT_PRICE_ANOMALY_THRESHOLD = "500"
DEFAULT_WINDOW = "1 minute"
DEFAULT_WATERMARK_DELAY = "10 seconds"
DEFAULT_BURST_SPAN = "5 minutes"
DEFAULT_HISTOGRAM_CAPACITY = 1000
DEFAULT_CATALOG = "olist_catalog"
DEFAULT_WAREHOUSE = "s3a://warehouse/"
TABLE_REVENUE = "revenue_by_category"
TABLE_KPIS = "realtime_kpis"
TABLE_ALERTS = "order_alerts"
# Environment variables: KAFKA_BOOTSTRAP_SERVERS, CHECKPOINT_INTERVAL_MS, ICEBERG_ENABLED, ORDERS_TOPIC, REVENUE_SINK_TOPIC,
# ALERTS_SINK_TOPIC, KPI_SINK_TOPIC, SUSPICIOUS_ORDER_COUNT, PRICE_ANOMALY_THRESHOLD, ICEBERG_CATALOG_NAME, ICEBERG_WAREHOUSE,
# MINIO_ENDPOINT, MINIO_ROOT_USER, MINIO_ROOT_PASSWORD.

# Own choices.
TABLE_DATABASE = "order_results"
DEFAULT_QUARANTINE_TOPIC = "quarantined-orders"


@dataclass(frozen=True)
class JobConfig:
    bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS
    checkpoint_interval_ms: int = DEFAULT_CHECKPOINT_INTERVAL_MS
    table_enabled: bool = False
    orders_topic: str = DEFAULT_ORDERS_TOPIC
    revenue_topic: str = DEFAULT_REVENUE_TOPIC
    alerts_topic: str = DEFAULT_ALERTS_TOPIC
    kpi_topic: str = DEFAULT_KPI_TOPIC
    quarantine_topic: str = DEFAULT_QUARANTINE_TOPIC
    suspicious_order_count: int = DEFAULT_SUSPICIOUS_ORDER_COUNT
    price_anomaly_threshold: Decimal = Decimal(DEFAULT_PRICE_ANOMALY_THRESHOLD)
    window: str = DEFAULT_WINDOW
    watermark_delay: str = DEFAULT_WATERMARK_DELAY
    burst_span: str = DEFAULT_BURST_SPAN
    max_offsets_per_trigger: int | None = None   # bounds each micro-batch (and a hot key's rows in it)

    @property
    def trigger_interval(self) -> str:
        return f"{self.checkpoint_interval_ms} milliseconds"

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "JobConfig":
        e = os.environ if env is None else env
        return cls(
            bootstrap_servers=e.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BOOTSTRAP_SERVERS),
            checkpoint_interval_ms=int(e.get("CHECKPOINT_INTERVAL_MS", DEFAULT_CHECKPOINT_INTERVAL_MS)),
            table_enabled=e.get("ICEBERG_ENABLED", "false").lower() == "true",
            orders_topic=e.get("ORDERS_TOPIC", DEFAULT_ORDERS_TOPIC),
            revenue_topic=e.get("REVENUE_SINK_TOPIC", DEFAULT_REVENUE_TOPIC),
            alerts_topic=e.get("ALERTS_SINK_TOPIC", DEFAULT_ALERTS_TOPIC),
            kpi_topic=e.get("KPI_SINK_TOPIC", DEFAULT_KPI_TOPIC),
            quarantine_topic=e.get("QUARANTINE_SINK_TOPIC", DEFAULT_QUARANTINE_TOPIC),
            suspicious_order_count=int(e.get("SUSPICIOUS_ORDER_COUNT", DEFAULT_SUSPICIOUS_ORDER_COUNT)),
            price_anomaly_threshold=Decimal(e.get("PRICE_ANOMALY_THRESHOLD", DEFAULT_PRICE_ANOMALY_THRESHOLD)),
            max_offsets_per_trigger=int(e["MAX_OFFSETS_PER_TRIGGER"]) if e.get("MAX_OFFSETS_PER_TRIGGER") else None,
        )


def catalog_name(env: dict[str, str] | None = None) -> str:
    return (os.environ if env is None else env).get("ICEBERG_CATALOG_NAME", DEFAULT_CATALOG)


def result_database(env: dict[str, str] | None = None, table_format: str = "iceberg") -> str:
    """The database of the result tables, in the table catalog unless the tables are plain files."""
    return f"{catalog_name(env)}.{TABLE_DATABASE}" if table_format == "iceberg" else TABLE_DATABASE


def table_catalog_settings(env: dict[str, str] | None = None) -> dict[str, str]:
    """Spark settings for the result-table catalog (an Iceberg file-system catalog on S3-compatible
    storage), from the same environment variables as the original jobs. Credentials are read from
    the environment at call time and never stored in code; pass the result to ``build_session``
    (the Iceberg runtime jar must be on the classpath)."""
    e = os.environ if env is None else env
    name = catalog_name(e)
    out = {
        f"spark.sql.catalog.{name}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{name}.type": "hadoop",
        f"spark.sql.catalog.{name}.warehouse": e.get("ICEBERG_WAREHOUSE", DEFAULT_WAREHOUSE),
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if "MINIO_ENDPOINT" in e:
        out["spark.hadoop.fs.s3a.endpoint"] = e["MINIO_ENDPOINT"]
    if "MINIO_ROOT_USER" in e and "MINIO_ROOT_PASSWORD" in e:
        out["spark.hadoop.fs.s3a.access.key"] = e["MINIO_ROOT_USER"]
        out["spark.hadoop.fs.s3a.secret.key"] = e["MINIO_ROOT_PASSWORD"]
    return out
