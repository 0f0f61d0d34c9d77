import json
from decimal import Decimal

from conftest import at, event
from pyspark.sql import functions as F

from cartwheel.operators.alerts import price_anomaly_alerts
from cartwheel.operators.bursts import suspicious_frequency_alerts
from cartwheel.operators.kpis import realtime_kpis
from cartwheel.operators.revenue import revenue_by_category
from cartwheel.sinks.json_encode import alert_json, kpi_json, revenue_json
from cartwheel.sources.messages import decode_order_messages, decode_outcomes, encode_order_events

VALID = ('{"order_id":"ord-7f","customer_id":"buyer-21","order_status":"delivered",'
         '"order_purchase_timestamp":"2024-01-01 00:00:00","product_category":"garden",'
         '"price":41.75,"freight_value":3.20,"seller_id":"shop-4"}')


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_valid_malformed_empty(spark):
    msgs = messages(spark, [VALID, "<order>no json</order>", "", None])
    [r] = decode_order_messages(msgs).collect()
    assert (r.order_id, r.product_category, r.price, r.order_purchase_timestamp) == (
        "ord-7f", "garden", Decimal("41.75"), at(0))
    counts = {r.outcome: r.messages for r in decode_outcomes(msgs).collect()}
    assert counts == {"valid": 1, "malformed": 1, "empty": 2}


def test_decode_bad_field_fails_whole_message_and_unknown_fields_ignored(spark):
    bad_ts = VALID.replace("2024-01-01 00:00:00", "yesterday")
    bad_price = VALID.replace("41.75", '"ten"')
    extra = VALID[:-1] + ',"totalValue":44.95,"whatever":[1,2]}'
    missing = '{"order_id":"m1","order_purchase_timestamp":"2024-01-01 00:00:05"}'
    rows = decode_order_messages(messages(spark, [bad_ts, bad_price, extra, missing, "null", "[1,2]"])).collect()
    assert sorted(r.order_id for r in rows) == ["m1", "ord-7f"]
    m1 = [r for r in rows if r.order_id == "m1"][0]
    assert m1.price is None and m1.customer_id is None and m1.order_purchase_timestamp == at(5)


def test_encode_then_decode_round_trip(events, spark):
    df = events([event("o1", price="12.30", freight="1.00", t=7.5, product="p1"), event("o2", price=None, category=None)])
    enc = encode_order_events(df)
    first = json.loads(enc.where("key = 'o1'").first().value)
    assert first["order_purchase_timestamp"] == "2024-01-01 00:00:07" and first["totalValue"] == 13.3
    assert "product_category" in json.loads(enc.where("key = 'o2'").first().value)  # nulls written
    back = {r.order_id: r for r in decode_order_messages(enc).collect()}
    assert back["o1"].price == Decimal("12.30") and back["o1"].order_purchase_timestamp == at(7)
    assert back["o2"].price is None


def test_result_json_text(events):
    df = events([event("order1", price="1.50", t=0)])
    assert revenue_json(revenue_by_category(df)).first().value == (
        '{"productCategory":"electronics","totalRevenue":1.50,"orderCount":1,'
        '"windowStart":1704067200.000000000,"windowEnd":1704067260.000000000}')
    assert kpi_json(realtime_kpis(df)).first().value == (
        '{"averageOrderValue":1.50,"ordersPerMinute":1.0,"totalOrders":1,"totalRevenue":1.50,'
        '"windowStart":1704067200.000000000,"windowEnd":1704067260.000000000}')


def test_alert_json_keeps_nulls(events):
    df = events([event(f"o{i}", price="600.00", t=i + 0.25) for i in range(3)])
    texts = {json.loads(r.value)["alertType"]: r.value
             for r in alert_json(suspicious_frequency_alerts(df).unionByName(price_anomaly_alerts(df))).collect()}
    assert texts["SUSPICIOUS_FREQUENCY"] == ('{"alertType":"SUSPICIOUS_FREQUENCY","entityId":"customer1",'
                                             '"description":"3 orders in less than 5 minutes","value":null,'
                                             '"detectedAt":1704067202.250000000}')
    assert '"value":600.00' in texts["PRICE_ANOMALY"]


def test_amounts_keep_their_digits(spark):
    msgs = messages(spark, [VALID.replace("41.75", p) for p in ["500.004", "12345678901.50", "500", "499.999999", '"500.01"', '""', "null"]])
    rows = decode_order_messages(msgs).collect()
    assert [r.price for r in rows] == [Decimal("500.004"), Decimal("12345678901.5"), Decimal("500"), Decimal("499.999999"),
                                       Decimal("500.01"), None, None]
    alerts = {r.description for r in price_anomaly_alerts(decode_order_messages(msgs), "500").collect()}
    assert alerts == {"Order price 500.004 exceeds threshold 500", "Order price 12345678901.50 exceeds threshold 500",
                      "Order price 500.01 exceeds threshold 500"}


def test_text_fields_take_scalars_only(spark):
    values = ["{}", '{"a":1}', "[1]", '"{}"', '"[x"', "17", "true", "null"]
    rows = decode_order_messages(messages(spark, [VALID.replace('"ord-7f"', v) for v in values])).collect()
    assert [r.order_id for r in rows] == ["{}", "[x", "17", "true", None]
    blank = [VALID.replace('"2024-01-01 00:00:00"', '""'), VALID.replace("3.20", '" "')]
    rows = decode_order_messages(messages(spark, blank)).collect()
    assert rows[0].order_purchase_timestamp is None and rows[1].freight_value is None


def test_encoded_amounts(events, spark):
    df = events([event("a", price="12.30", freight="1.004000"), event('b":1.230000,', price="7", freight=None)])
    texts = {r.key: r.value for r in encode_order_events(df).collect()}
    assert '"price":12.30,"freight_value":1.004,"totalValue":13.304}' in texts["a"]
    assert json.loads(texts['b":1.230000,'])["order_id"] == 'b":1.230000,' and '"price":7.00,' in texts['b":1.230000,']
