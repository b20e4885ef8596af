import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfmark.session import get_session

    return get_session(master="local[8]", shuffle_partitions=8)


@pytest.fixture(scope="session")
def cat(spark):
    from shelfmark.sources import Catalogue

    return Catalogue.cached(spark, SMOKE)
