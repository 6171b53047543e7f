import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    home = tempfile.mkdtemp(prefix="tests-")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"file://{home}/warehouse").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
