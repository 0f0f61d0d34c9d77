"""CSV files cut at byte ranges, whatever stands inside quotes."""
import csv
import io
import pickle
import random
from collections import Counter
from contextlib import contextmanager
from datetime import datetime

import pytest

from cartwheel.sources import csv as module
from cartwheel.sources.csv import enriched_events_from_csv, first_pass, range_counts, records

COLUMNS = ["a", "b", "c"]


@contextmanager
def small_ranges(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def made(seed, n, end="\n"):
    r = random.Random(seed)
    value = lambda: "".join(r.choice(["x", "yz", " ", ",", '"', "\n", '""', "é", "\n\n", "1.5"]) for _ in range(r.randint(0, 12))).strip()
    out = io.StringIO()
    w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end)
    rows = [[f"id{i}", value(), value() if i % 7 else "long\nvalue\n" * 40 + "end"] for i in range(n)]
    w.writerow(COLUMNS)
    w.writerows(rows)
    return out.getvalue(), rows


def text_of(v):
    return v or None


@pytest.mark.parametrize("size", [40, 97, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_whole_file(spark, tmp_path, size, end):
    text, rows = made(size, 150, end)
    path = tmp_path / "one.csv"
    path.write_bytes(text.encode())
    with small_ranges(spark, size):
        found = first_pass(spark, str(path))
        assert not found.uncut and (size > 10_000 or len(found.ranges) > 5)
        assert size > 100 or any(r.inside for r in found.ranges.values())
        got = module._read_csv(spark, str(path), COLUMNS, "place").collect()
    assert Counter(tuple(map(text_of, r[:3])) for r in got) == Counter(tuple(map(text_of, r)) for r in rows)
    ordered = sorted(got, key=lambda r: tuple(r.place))
    assert [r.a for r in ordered] == [r[0] for r in rows]       # places are those of the input
    reader = spark.read.options(header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    want = [tuple(r) for r in reader.csv(str(path)).collect()]
    assert Counter(map(str, (tuple(r[:3]) for r in got))) == Counter(map(str, want))


def test_column_orders_empty_files_and_stray_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n1,"x\ny",z\n\n2,,\n')
    (tmp_path / "b.csv").write_text('c , b,extra,a\r\nz3," q ""r"" ",e,3\r\n')
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('a,b,c\n4,5" pipe,x\n5,6,7\n')       # a quote in a value that is not quoted
    (tmp_path / "e.csv").write_text("a,b,c\n")
    with small_ranges(spark, 12):
        assert {f.rsplit("/", 1)[1] for f in first_pass(spark, str(tmp_path)).uncut} == {"d.csv"}
        got = {r.a: (r.b, r.c) for r in module._read_csv(spark, str(tmp_path), COLUMNS).collect()}
    assert got == {"1": ("x\ny", "z"), "2": (None, None), "3": (' q "r" ', "z3"), "4": ('5" pipe', "x"), "5": ("6", "7")}
    (tmp_path / "f.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        module._read_csv(spark, str(tmp_path), COLUMNS)


def test_last_category_wins_and_equal_times_stay_in_order(spark, tmp_path):
    (tmp_path / "olist_products_dataset.csv").write_text("product_id,product_category_name\np1,zoo\np2,x\np1,art\np1,\n" + "p9,pad\n" * 30 + "p2,a\n")
    orders = [f"o{i},c,delivered,2024-01-01 00:00:0{i % 2}\n" for i in (5, 3, 8, 1, 9, 2)]
    (tmp_path / "olist_orders_dataset.csv").write_text("order_id,customer_id,order_status,order_purchase_timestamp\n" + "".join(orders))
    items = [f"o{i},{p},s{k},{k}.00,0\n" for k, (i, p) in enumerate([(9, "p2"), (3, "p1"), (9, "p1"), (3, "p2"), (3, "p1"), (2, "p1")])]
    (tmp_path / "olist_order_items_dataset.csv").write_text("order_id,product_id,seller_id,price,freight_value\n" + "".join(items))
    with small_ranges(spark, 30):
        rows = enriched_events_from_csv(spark, str(tmp_path)).collect()
    assert [(r.order_id, r.seller_id) for r in rows] == [("o8", None), ("o2", "s5"), ("o5", None), ("o3", "s1"), ("o3", "s3"), ("o3", "s4"), ("o1", None),
                                                          ("o9", "s0"), ("o9", "s2")]
    assert {(r.product_id, r.product_category) for r in rows if r.product_id} == {("p1", "art"), ("p2", "a")}
    assert rows[0].order_purchase_timestamp == datetime(2024, 1, 1) and "order_position" not in rows[0]


def test_lines_are_not_sorted_for_the_head(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"2"\n')
    counts = range_counts(spark, str(tmp_path))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    assert [(r.odd, r.stray, r["head"]) for r in counts.collect()] == [(0, 0, "x,y")]


def test_executors_need_no_package_for_the_ranges(spark, tmp_path, monkeypatch):
    """A broadcast is pickled by reference to its classes."""
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    files, sent = first_pass(spark, str(tmp_path)), []
    send = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or send(self, value))
    assert records(spark, str(tmp_path), files).count() == 2
    assert sent and b"cartwheel" not in pickle.dumps(sent[0])


def test_line_ends_stay_out_of_values(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'x,y\r\n1,"2\r\n"\r\n3,4\n5,"6\n"')
    rows = module._read_csv(spark, str(tmp_path), ["x", "y"]).collect()
    assert sorted((r.x, r.y) for r in rows) == [("1", "2\r\n"), ("3", "4"), ("5", "6\n")]
