import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cabflow.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=8, app="cabflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lake_root(spark):
    from cabflow.sources.testlake import fixture_lake

    return fixture_lake(spark, SF_SMALL)
