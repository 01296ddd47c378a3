import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session

    s = session("8")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s


@pytest.fixture(scope="session")
def district(spark):
    from checks.queries import District

    return District(spark, SF)
