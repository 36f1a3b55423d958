import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from letterlake.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def topic_of(spark):
    """Texts as records of a topic, one offset after the other."""
    from letterlake.schemas import TOPIC

    import datetime as dt

    def build(*values, topic="test", start=0):
        noon = dt.datetime(2024, 1, 1, 12)
        rows = [
            (None, value, topic, 0, start + i, noon + dt.timedelta(seconds=start + i))
            for i, value in enumerate(values)
        ]
        return spark.createDataFrame(rows, TOPIC)

    return build
