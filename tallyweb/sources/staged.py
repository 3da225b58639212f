"""Tables written once and read again, so that lost executors cost no recomputation of what came before."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a new local one if Spark is one process (as in tests), and
    an error on a cluster: its machines would not see each other's files."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append("file://" + tempfile.mkdtemp(prefix="tallyweb-"))
    return _local[0]


def staged_dir(spark: SparkSession) -> str:
    """This application's folder of staged tables."""
    return f"{shared_dir(spark)}/staged/{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df`, written as Parquet in the shared folder and read again."""
    spark = df.sparkSession
    path = f"{staged_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Removes this application's staged tables: to be called once no result that may read them is open any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staged_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
