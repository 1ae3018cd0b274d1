import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from roomsight.session import session

    s = session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                        "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def raw(spark, folder):
    from roomsight.plans.readings import readings

    return readings(spark, folder)
