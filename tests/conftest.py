import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeworks.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "gaugeworks-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
