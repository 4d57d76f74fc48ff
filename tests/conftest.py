import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from tripflow.session import configure

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tripflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tripflow-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    return collect
