"""Plan properties the scale design relies on (checked on the executed plan text)."""

import re

from conftest import SF001

from cartwheel.operators.bursts import suspicious_frequency_alerts
from cartwheel.operators.distribution import kpi_value_distribution
from cartwheel.operators.kpis import realtime_kpis
from cartwheel.operators.revenue import revenue_by_category
from cartwheel.plans.queries import QUERIES
from cartwheel.sources.feeds import event_feed, item_feed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def physical(df) -> str:
    """The initial physical plan under AQE (before runtime re-planning)."""
    p = plan(df)
    return p.split("+- == Initial Plan ==")[-1] if "Initial Plan" in p else p


def test_windowed_aggregates_are_two_phase_without_expand(spark):
    for df in [revenue_by_category(event_feed(spark, SF001)), realtime_kpis(event_feed(spark, SF001))]:
        p = physical(df)
        assert p.count("Exchange hashpartitioning") == 1
        assert "partial_sum" in p and "partial_count" in p
        assert "Expand" not in p
        # only the needed columns are read
        assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>", p)


def test_bursts_pre_aggregate_then_one_window_sort(spark):
    p = physical(suspicious_frequency_alerts(event_feed(spark, SF001), 3, "1 day"))
    # simultaneous events are counted map-side before the first shuffle
    first_exchange = p.rindex("Exchange hashpartitioning(customer_id")
    assert "partial_count" in p[first_exchange:]
    assert p.count("Exchange hashpartitioning(customer_id") == 2
    assert p.count("Sort [customer_id") == 1
    assert "RangeFrame, unboundedpreceding$(), -86400000000" in p
    assert "Join" not in p


def test_decode_parses_each_message_once(spark):
    p = physical(QUERIES["decode_order_json"](spark, SF001))
    assert p.count("from_json(") == 1


def test_enrichment_has_no_cartesian_or_nested_loop(spark):
    p = physical(item_feed(spark, SF001))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "LeftAnti" in p and "Inner" in p


def test_distribution_retains_a_bounded_top_k(spark):
    p = physical(kpi_value_distribution(realtime_kpis(event_feed(spark, SF001)), 1000))
    assert "TakeOrderedAndProject(limit=1000" in p
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_enrichment_shares_the_orders_shuffle_and_broadcasts_only_measured_sides(spark):
    df = item_feed(spark, SF001)
    df.collect()  # run this DataFrame's own plan so that AQE's final plan is visible
    p = plan(df)
    final = p.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    assert "ReusedExchange" in final          # the inner and the anti join read one orders shuffle
    initial = p.split("== Initial Plan ==")[-1]
    if spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1":
        assert "BroadcastHashJoin" not in initial   # no broadcast from planning estimates


def test_batch_aggregates_filter_before_the_joins(spark):
    p = physical(revenue_by_category(item_feed(spark, SF001), "1 day"))
    assert "LeftAnti" not in p and p.count("FileScan parquet") == 3


def test_distribution_reads_the_kpis_once(spark):
    df = kpi_value_distribution(realtime_kpis(event_feed(spark, SF001)), 1000)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 1
