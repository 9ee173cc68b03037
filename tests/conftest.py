import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footings.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.log.level": "ERROR"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate expressions over literals: one(lambda col, …: expression, values…)."""
    from pyspark.sql import functions as F

    def run(fn, *values, kinds=None):
        kinds = kinds or ["double" if isinstance(v, float) else "string" for v in values]
        cols = [F.lit(v).cast(k) for v, k in zip(values, kinds)]
        return spark.range(1).select(fn(*cols).alias("v")).first()["v"]

    return run
