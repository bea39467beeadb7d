import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from storyspark.session import STATIC, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g"))
    for key, value in STATIC.items():
        builder = builder.config(key, value)
    session = prepare(builder.getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
