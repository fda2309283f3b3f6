import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lexiloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark, tmp_path):
    return str(tmp_path)


@pytest.fixture
def value(spark):
    """The value of one expression over a one-row table."""

    def evaluate(expression):
        return spark.range(1).select(expression.alias("v")).first()["v"]

    return evaluate


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
