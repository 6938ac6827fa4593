import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sensorwerk.config import build_session
    s = build_session("local[4]", app_name="sensorwerk-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):  # tests only: the cluster names its own
        d = tempfile.mkdtemp(prefix="sensorwerk-ckpt-", dir="/tmp")
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test (never cleaned up by the tests themselves)."""
    return tempfile.mkdtemp(prefix="sensorwerk-test-", dir="/tmp")
