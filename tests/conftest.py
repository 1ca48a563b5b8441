import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    # the checkpoint dir comes from the session (spark-defaults / cluster);
    # only where it is unset does the library pick a folder (RISKWEAVE_SCRATCH)
    os.environ.setdefault("RISKWEAVE_SCRATCH", tempfile.mkdtemp(prefix="riskweave-tests-"))
    s = (SparkSession.builder.master("local[*]")
         .appName("riskweave-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
