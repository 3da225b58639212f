import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    from tallyweb.session import SETTINGS

    builder = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
