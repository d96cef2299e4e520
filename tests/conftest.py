import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
