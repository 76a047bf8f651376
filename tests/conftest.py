import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from landfall.session import build_session

    s = build_session("local[*]", app_name="landfall-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from landfall.session import scratch_path

    return scratch_path(spark, "test")


def rows(df):
    return sorted(tuple(r) for r in df.collect())
