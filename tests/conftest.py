import os
import sys
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.schemas import ORDER_EVENT  # noqa: E402
from cartwheel.session import build_session  # noqa: E402

BASE = datetime(2024, 1, 1, 0, 0, 0)
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", "cartwheel-tests", 8,
                      {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


def event(order_id="o1", customer="customer1", seller="seller1", price="10.00", t=0.0,
          category="electronics", freight=None, product=None, status="delivered"):
    return (order_id, customer, status, at(t), product, seller, category,
            None if price is None else Decimal(price), None if freight is None else Decimal(freight))


@pytest.fixture
def events(spark):
    def make(rows):
        return spark.createDataFrame(rows, ORDER_EVENT)
    return make
