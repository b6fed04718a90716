import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import get_spark
    s = get_spark("local[4]", app_name="tidemill-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def db(spark):
    from tidemill.plans.catalogue import fresh_database
    return fresh_database(spark)
