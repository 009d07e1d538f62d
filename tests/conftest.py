import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logweave import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", shuffle_partitions=8, app="logweave-tests")
    yield s


@pytest.fixture
def lines_df(spark):
    def make(lines):
        return spark.createDataFrame([(x,) for x in lines], "raw string")

    return make


def line(ts="2031-11-02T09:15:42.875Z", service="order-service", level="INFO", rid="job-77f0", msg="Invoice stored", lat="latency=63ms"):
    return " | ".join([ts, service, level, rid, msg, lat])
