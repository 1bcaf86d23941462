import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from tidemill.session import SETTINGS


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidemill-tests-")
    builder = SparkSession.builder.master("local[4]").appName("tests")
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/work",
    }.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a frame from tuples and a schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def folder(tmp_path: Path) -> str:
    return str(tmp_path)
