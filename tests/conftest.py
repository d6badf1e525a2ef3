import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=4, app="tidemark-tests")
    yield s


@pytest.fixture()
def tmp_shared(spark):
    """A fresh folder under the shared checkpoint dir."""
    from tidemark.session import scratch_path

    return scratch_path(spark, "test")


def ts(text: str):
    import datetime as dt

    return dt.datetime.fromisoformat(text)


def hours(start: str, n: int, step: int = 1):
    import datetime as dt

    t0 = dt.datetime.fromisoformat(start)
    return [t0 + dt.timedelta(hours=i * step) for i in range(n)]
