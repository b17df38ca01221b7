import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("CONFLUO_TEST_SF", "/root/testdata/sf0.001")
SF_CHECK = os.environ.get("CONFLUO_CHECK_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from confluo.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="confluo-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def sf_check():
    return SF_CHECK
