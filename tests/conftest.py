import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = os.environ.get("URBANLAKE_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("URBANLAKE_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[*]").appName("urbanlake-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", os.environ.get("URBANLAKE_DRIVER_MEMORY", "6g"))
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.adaptive.enabled", "true"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # a checkpoint folder of our own only where the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="urbanlake-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir(spark):
    from urbanlake.session import work_path

    return work_path(spark, "test")
