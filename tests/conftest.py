import os
import sys

import pytest
from hypothesis import HealthCheck, settings

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewloom.session import open_session  # noqa: E402


# Every example is a Spark job; the same examples run each time.
settings.register_profile("spark", derandomize=True, deadline=None,
                          suppress_health_check=list(HealthCheck))
settings.load_profile("spark")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A failed task is tried once more, as on a cluster.
    session = open_session("tests", "local[8, 2]", {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")
    return make
