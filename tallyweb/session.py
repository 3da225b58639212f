"""Session settings that the plans are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows dealt by page_id serve joins on (page_id, node_id) as well
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # pages are long rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def session(name: str = "tallyweb", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
