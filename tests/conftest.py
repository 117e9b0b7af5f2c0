import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lodestrata.session import local_session

    session = local_session("tests", cores="4", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Applies a column function to one text."""
    from pyspark.sql import functions as F

    def apply(function, text):
        return spark.createDataFrame([(text,)], "t string").select(function(F.col("t"))).first()[0]

    return apply
