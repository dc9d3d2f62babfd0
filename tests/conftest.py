import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millstream.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", 4,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from millstream.session import scratch_path

    def fresh(name="test"):
        return scratch_path(spark, name)

    return fresh


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
