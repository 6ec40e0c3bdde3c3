import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from trendloom.session import checkpoint_root, local_session

    s = local_session(cores=4, shuffle_partitions=8, app="trendloom-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s


@pytest.fixture()
def scratch(spark):
    from trendloom.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)

    return make
