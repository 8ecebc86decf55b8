import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from enrichlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("FATAL")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression over one row of named values."""

    def run(expression, schema, *values):
        return spark.createDataFrame([values], schema).select(expression.alias("v")).first()["v"]

    return run
