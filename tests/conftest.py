import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barwright.session import get_spark

    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
