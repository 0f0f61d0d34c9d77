import random
from decimal import Decimal

from conftest import at, event

from cartwheel.operators.alerts import price_anomaly_alerts, union_alerts
from cartwheel.operators.bursts import suspicious_frequency_alerts


def test_detects_price_anomaly(events):
    df = events([event("order1", seller="seller1", price="50.00", t=0),
                 event("order2", seller="seller2", price="600.00", t=10),
                 event("order3", seller="seller3", price="1000.00", t=20)])
    rows = sorted(price_anomaly_alerts(df, "500").collect(), key=lambda r: r.entity_id)
    assert [r.alert_type for r in rows] == ["PRICE_ANOMALY"] * 2
    assert [(r.entity_id, r.value, r.detected_at) for r in rows] == [
        ("seller2", Decimal("600.00"), at(10)), ("seller3", Decimal("1000.00"), at(20))]
    assert rows[0].description == "Order price 600.00 exceeds threshold 500"


def test_price_at_threshold_is_not_anomaly(events):
    df = events([event("order1", price="500.00", t=0), event("order2", price="499.99", t=10),
                 event("order3", price=None, t=20)])
    assert price_anomaly_alerts(df, "500").count() == 0


def test_detects_suspicious_frequency(events):
    df = events([event("order1", customer="suspicious-customer", t=0),
                 event("order2", customer="suspicious-customer", t=30),
                 event("order3", customer="suspicious-customer", t=60),
                 event("order4", customer="normal-customer", t=90)])
    [a] = suspicious_frequency_alerts(df, 3).collect()
    assert (a.alert_type, a.entity_id, a.detected_at, a.value) == ("SUSPICIOUS_FREQUENCY", "suspicious-customer", at(60), None)
    assert a.description == "3 orders in less than 5 minutes"


def test_two_orders_do_not_trigger(events):
    df = events([event("order1", t=0), event("order2", t=30)])
    assert suspicious_frequency_alerts(df, 3).count() == 0


def test_four_orders_give_three_runs(events):
    df = events([event(f"o{i}", t=10 * i) for i in range(4)])
    got = sorted((r.detected_at, r.description) for r in suspicious_frequency_alerts(df, 3).collect())
    assert got == [(at(20), "3 orders in less than 5 minutes"), (at(30), "3 orders in less than 5 minutes"),
                   (at(30), "4 orders in less than 5 minutes")]


def test_span_is_strict(events):
    exact = events([event("a", t=0), event("b", t=100), event("c", t=300)])
    assert suspicious_frequency_alerts(exact, 3).count() == 0
    inside = events([event("a", t=0.000001), event("b", t=100), event("c", t=300)])
    assert suspicious_frequency_alerts(inside, 3).count() == 1


def test_ties_and_null_customer(events):
    df = events([event(f"o{i}", t=0) for i in range(3)] + [event("x", customer=None, t=0)] * 3)
    got = [r.description for r in suspicious_frequency_alerts(df, 3).collect()]
    assert got == ["3 orders in less than 5 minutes"]


def brute_force(rows, n, span_s):
    by_customer = {}
    for r in rows:
        if r[1] is not None:
            by_customer.setdefault(r[1], []).append(r)
    out = []
    for c, evs in by_customer.items():
        evs.sort(key=lambda r: (r[3], r[0]))
        for j in range(len(evs)):
            for i in range(j + 1):
                if j - i + 1 >= n and (evs[j][3] - evs[i][3]).total_seconds() < span_s:
                    out.append((c, evs[j][3], j - i + 1))
    return sorted(out)


def test_bursts_match_brute_force_across_buckets(events):
    rnd = random.Random(7)
    rows = []
    # one hot customer over many buckets, several light ones; times cross bucket edges
    for i in range(400):
        c = "hot" if rnd.random() < 0.6 else f"c{rnd.randint(1, 5)}"
        rows.append(event(f"o{i:04d}", customer=c, t=rnd.randint(0, 20000) + rnd.choice([0, 0.5])))
    df = events(rows)
    for bucket in [None, "5 minutes", "17 minutes"]:
        got = sorted((r.entity_id, r.detected_at, int(r.description.split()[0]))
                     for r in suspicious_frequency_alerts(df, 3, "5 minutes", bucket).collect())
        assert got == brute_force(rows, 3, 300)


def test_union_keeps_both_kinds(events):
    df = events([event(f"o{i}", price="900.00", t=i) for i in range(3)])
    u = union_alerts(suspicious_frequency_alerts(df, 3), price_anomaly_alerts(df, "500"))
    kinds = sorted(r.alert_type for r in u.collect())
    assert kinds == ["PRICE_ANOMALY"] * 3 + ["SUSPICIOUS_FREQUENCY"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

GRID = st.lists(st.tuples(st.sampled_from(["a", "b"]),
                          st.tuples(st.integers(0, 20), st.integers(0, 1)).map(lambda kj: kj[0] * 60 + kj[1] * 1e-6)),
                min_size=3, max_size=30)


@settings(max_examples=25, deadline=None)
@given(GRID, st.integers(2, 4), st.sampled_from(["5 minutes", "6 minutes"]))
def test_bursts_property_bucket_edges(spark, rows, n, bucket):
    from conftest import BASE, event  # noqa: F401
    from cartwheel.schemas import ORDER_EVENT
    evs = [event(f"o{i}", customer=c, t=t) for i, (c, t) in enumerate(rows)]
    df = spark.createDataFrame(evs, ORDER_EVENT)
    got = sorted((r.entity_id, r.detected_at, int(r.description.split()[0]))
                 for r in suspicious_frequency_alerts(df, n, "5 minutes", bucket).collect())
    assert got == brute_force(evs, n, 300)
