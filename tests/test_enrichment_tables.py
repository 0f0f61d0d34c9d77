from decimal import Decimal

from conftest import at

from cartwheel.sinks.tables import create_result_tables, read_revenue, to_alert_rows, to_revenue_rows
from cartwheel.sources.csv import enriched_events_from_csv


def write(path, text):
    path.write_text(text)


def test_csv_enrichment(spark, tmp_path):
    write(tmp_path / "olist_orders_dataset.csv",
          "order_id,customer_id,order_status,order_purchase_timestamp,extra\n"
          " o1 , c1 ,delivered, 2024-01-01 00:00:10 ,x\n"
          "o2,c2,shipped,2024-01-01 00:00:05,x\n"
          "o3,c3,delivered,,x\n"
          "o4,c4,delivered,not a time,x\n")
    write(tmp_path / "olist_order_items_dataset.csv",
          "order_id,order_item_id,product_id,seller_id,price,freight_value\n"
          "o1,1,p1,s1, 10.50 ,1.25\n"
          "o1,2,p2,s2,abc,\n"
          "o1,3,p9,s3,3.00,0.10\n"
          "o3,1,p1,s1,5.00,1.00\n")
    write(tmp_path / "olist_products_dataset.csv",
          "product_id,product_category_name\n"
          "p1,toys\np2,\np1,toys\n")
    rows = enriched_events_from_csv(spark, str(tmp_path), sort=True).collect()
    # o3/o4 skipped (no or bad time), o2 has no items -> one bare event, sorted by time
    assert [r.order_id for r in rows] == ["o2", "o1", "o1", "o1"]
    assert rows[0].product_id is None and rows[0].price is None and rows[0].order_purchase_timestamp == at(5)
    by_product = {r.product_id: r for r in rows[1:]}
    assert by_product["p1"].product_category == "toys" and by_product["p1"].price == Decimal("10.50")
    assert by_product["p2"].product_category is None and by_product["p2"].price == Decimal("0.00")
    assert by_product["p2"].freight_value == Decimal("0.00")
    assert by_product["p9"].product_category is None
    assert rows[1].customer_id == "c1"


def test_table_coercion(spark):
    df = spark.createDataFrame([("x", Decimal("2.345"), 1, at(0), at(60)),
                                ("y", Decimal("12345678901.00"), 2, at(0), at(60))],
                               "product_category string, total_revenue decimal(22,3), order_count long, "
                               "window_start timestamp, window_end timestamp")
    rows = {r.product_category: r for r in to_revenue_rows(df).collect()}
    assert rows["x"].total_revenue == Decimal("2.35") and rows["y"].total_revenue is None
    assert str(rows["x"].window_date) == "2024-01-01"
    a = spark.createDataFrame([("PRICE_ANOMALY", "s", "d", Decimal("1.005"), at(0))],
                              "alert_type string, entity_id string, description string, value decimal(10,3), detected_at timestamp")
    assert to_alert_rows(a).first().value == Decimal("1.01")


def test_create_tables_and_partition_pruning(spark, tmp_path):
    names = create_result_tables(spark, "tables_test", "parquet", str(tmp_path / "wh"))
    assert names == ["tables_test.revenue_by_category", "tables_test.realtime_kpis", "tables_test.order_alerts"]
    create_result_tables(spark, "tables_test", "parquet", str(tmp_path / "wh"))  # idempotent
    df = spark.createDataFrame([("x", Decimal("1.00"), 1, at(0), at(60)), ("x", Decimal("2.00"), 1, at(86400), at(86460))],
                               "product_category string, total_revenue decimal(12,2), order_count long, "
                               "window_start timestamp, window_end timestamp")
    from cartwheel.sinks.tables import append_revenue
    append_revenue(df, names[0])
    got = read_revenue(spark, names[0], start=at(86400))
    assert [r.total_revenue for r in got.collect()] == [Decimal("2.00")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan


def test_csv_quoting_column_order_and_wide_amounts(spark, tmp_path):
    write(tmp_path / "olist_orders_dataset.csv", 'order_id,customer_id,order_status,order_purchase_timestamp\n"o1","c ""x"", y",delivered,2024-01-01 00:00:10\n')
    items = tmp_path / "olist_order_items_dataset.csv"
    items.mkdir()
    write(items / "a.csv", "order_id,product_id,seller_id,price,freight_value\no1,p1,s1,12345678901.50,0.004\n")
    write(items / "b.csv", "freight_value,price,seller_id,order_id,product_id,extra\n2,7,s2,o1,p2,z\n")
    write(items / "c.csv", "")
    write(tmp_path / "olist_products_dataset.csv", 'product_id,product_category_name\np1,"say ""hi"", ok"\np2,"two\nlines"\n')
    rows = {r.product_id: r for r in enriched_events_from_csv(spark, str(tmp_path)).collect()}
    assert rows["p1"].product_category == 'say "hi", ok' and rows["p2"].product_category == "two\nlines"
    assert (rows["p1"].price, rows["p1"].freight_value) == (Decimal("12345678901.5"), Decimal("0.004"))
    assert (rows["p2"].price, rows["p2"].freight_value, rows["p2"].seller_id) == (Decimal("7"), Decimal("2"), "s2")
    assert rows["p1"].customer_id == 'c "x", y'
