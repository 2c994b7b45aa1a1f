import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tessera.session import DEFAULTS, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    b = SparkSession.builder.master("local[*]").appName("tessera-tests")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", "4g")  # one JVM for all tests; its Arrow pools grow with it
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
