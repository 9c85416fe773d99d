import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="starloom-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def wh_root(spark):
    return scratch_path(spark, "test-wh")
