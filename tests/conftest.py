import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
NOW = dt.datetime(2026, 1, 1)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    wh = tempfile.mkdtemp(prefix="meteora-wh-")
    s = (SparkSession.builder.master("local[4]")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", wh)
         .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={wh}")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="meteora-ck-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("OFF")
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="meteora-t-")
