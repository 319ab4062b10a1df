import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session(app="tests", master="local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
