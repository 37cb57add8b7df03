import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vacancia.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate expressions over one row: one(value=..., f(col)) -> python value."""

    def run(expression, **values):
        fields = ", ".join(f"{k} string" for k in values)
        return spark.createDataFrame([tuple(values.values())], fields).select(expression).first()[0]

    return run
