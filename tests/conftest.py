import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from inkmill.session import local_session

    session = local_session(4, 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """The value of a column expression over a single text ``x``."""

    def value(make, text):
        from pyspark.sql import functions as F

        return spark.createDataFrame([(text,)], "x string").select(make(F.col("x")).alias("v")).first()["v"]

    return value
