import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="quarry-test-", dir="/tmp")
    s = (SparkSession.builder.master("local[4]").appName("quarry-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quarry-case-", dir="/tmp")
