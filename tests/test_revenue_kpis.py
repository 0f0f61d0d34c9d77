from decimal import Decimal

from conftest import at, event

from cartwheel.operators.kpis import realtime_kpis
from cartwheel.operators.revenue import revenue_by_category
from cartwheel.operators.validation import invalid_events, priced_events, valid_events


def test_revenue_groups_by_category(events):
    df = events([event("order1", price="100.00", t=0), event("order2", price="200.00", t=10),
                 event("order3", category="books", price="30.00", t=20)])
    rows = {r.product_category: r for r in revenue_by_category(df).collect()}
    assert rows["electronics"].total_revenue == Decimal("300.00")
    assert rows["electronics"].order_count == 2
    assert rows["books"].total_revenue == Decimal("30.00") and rows["books"].order_count == 1
    assert rows["electronics"].window_start == at(0) and rows["electronics"].window_end == at(60)


def test_revenue_null_price_filtered(events):
    df = events([event("order1", price="100.00", t=0), event("order2", price="200.00", t=10),
                 event("order-null", price=None, t=5)])
    [r] = revenue_by_category(df).collect()
    assert (r.total_revenue, r.order_count) == (Decimal("300.00"), 2)


def test_revenue_value_includes_freight_and_window_bounds(events):
    df = events([event("a", price="10.00", freight="1.50", t=59.999999), event("b", price="5.00", t=60)])
    rows = sorted(revenue_by_category(df).collect(), key=lambda r: r.window_start)
    assert [(r.window_start, r.total_revenue) for r in rows] == [(at(0), Decimal("11.50")), (at(60), Decimal("5.00"))]


def test_valid_invalid_split_is_complete(events):
    df = events([event("a"), event("b", price=None), event("c", category=None), event("d", price=None, category=None)])
    assert [r.order_id for r in valid_events(df).collect()] == ["a"]
    assert sorted(r.order_id for r in invalid_events(df).collect()) == ["b", "c", "d"]
    assert sorted(r.order_id for r in priced_events(df).collect()) == ["a", "c"]


def test_kpis_computed(events):
    df = events([event("order1", price="100.00", t=0), event("order2", price="200.00", t=10),
                 event("order3", price="300.00", t=20)])
    [k] = realtime_kpis(df).collect()
    assert (k.total_orders, k.total_revenue, k.average_order_value) == (3, Decimal("600.00"), Decimal("200.00"))
    assert k.orders_per_minute == 3.0


def test_kpis_null_price_filtered_and_null_category_kept(events):
    df = events([event("order1", price="100.00", t=0), event("order2", price="200.00", t=10, category=None),
                 event("order-null", price=None, t=5)])
    [k] = realtime_kpis(df).collect()
    assert (k.total_orders, k.total_revenue) == (2, Decimal("300.00"))


def test_kpi_average_rounds_half_up_and_no_empty_windows(events):
    df = events([event("a", price="0.01", t=0), event("b", price="0.00", t=1),
                 event("c", price="1.00", t=600)])
    rows = sorted(realtime_kpis(df).collect(), key=lambda r: r.window_start)
    assert len(rows) == 2  # nothing for the 9 empty minutes between
    assert rows[0].average_order_value == Decimal("0.01")  # 0.005 -> 0.01
    assert rows[1].average_order_value == Decimal("1.00")


def test_kpi_orders_per_minute_scales_with_window(events):
    df = events([event(str(i), price="1.00", t=i) for i in range(6)])
    [k] = realtime_kpis(df, "2 minutes").collect()
    assert k.orders_per_minute == 3.0
