import tempfile

import pytest
from pyspark.sql import SparkSession

from salesloom.session import configure

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="salesloom-tests-"))
    )
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from salesloom.plans.mart import mart
    return mart(spark, SMALL)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
    return collect
