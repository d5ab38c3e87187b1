import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from millrace.session import REQUIRED_CONF

    b = (SparkSession.builder.master("local[*]").appName("millrace-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g"))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    if not s.conf.get("spark.checkpoint.dir", None):  # tests only: no cluster folder is configured
        s.stop()
        s = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="millrace-test-ckpt-")).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle.compare import duck
    return duck(SF_SMALL)
