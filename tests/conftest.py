import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "lakemart-tests", master="local[8]", shuffle_partitions=8,
        **{"spark.ui.enabled": "false", "spark.sql.warehouse.dir": str(warehouse), "spark.driver.memory": "8g",
           "spark.sql.catalogImplementation": "in-memory"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
