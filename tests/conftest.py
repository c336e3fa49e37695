import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitchlake.session import get_spark
    s = get_spark(app="pitchlake-tests", master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def bed_mid(spark):
    from pitchlake.sources.tables import Testbed
    return Testbed(spark, SF_MID)


@pytest.fixture(scope="session")
def duck_small():
    from pitchlake.plans.verify import duck
    return duck(SF_SMALL)
