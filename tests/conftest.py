import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import build_session
    s = build_session(cpus=8, shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_out(spark):
    from ledgerloom.session import scratch_path
    return lambda name: scratch_path(spark, name)
