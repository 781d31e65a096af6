import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import tuned  # noqa: E402

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def session() -> SparkSession:
    spark = (
        tuned(SparkSession.builder).master("local[8]").appName("riskloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", os.environ.get("TEST_TZ", "UTC"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="riskloom-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="riskloom-shared-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    yield session()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
