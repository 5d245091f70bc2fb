import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    from tidemark.session import scratch_uri
    from tidemark.sources.store import Store

    return Store(spark, scratch_uri(spark, "test"))


@pytest.fixture
def records(spark):
    """Build VARIANT records from JSON texts, in order."""
    from tidemark.sources.records import records_from_json

    def make(*texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "ord bigint, line string")
        return records_from_json(rows, "line", ord="ord")

    return make
