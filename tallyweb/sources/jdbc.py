"""Tables of a database by JDBC: partitioned reads, and loads in which a key that is there already counts as saved.

Rows go between executors and the database only; through the driver go bounds, counts and statements.
The JDBC driver's jar must be on Spark's class path.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import first_of_each

ROWS_PER_TASK = 500_000
MAX_TASKS = 200  # connections that the database is asked to serve at once
KEY_TAKEN = "23505"  # SQLSTATE of a unique key's violation


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@contextmanager
def _connection(spark: SparkSession, options: dict[str, str]) -> Iterator[Any]:
    properties = spark._jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in options:
            properties.setProperty(k, options[k])
    connection = spark._jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        yield connection
    finally:
        connection.close()


def _run(connection: Any, sql: str) -> int:
    statement = connection.createStatement()
    try:
        return statement.executeUpdate(sql)
    finally:
        statement.close()


def read_jdbc(spark: SparkSession, options: dict[str, str], table: str, key: str | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A table of the database at `options` (url, user, password, ...), read by ranges of its numeric `key` in parallel.

    The ranges follow from the key's bounds and the number of rows, which the database tells. Filters on columns, such as
    those of status and id in load_queue(), are the database's work, so rows that they exclude don't travel. Rows
    without a key are read, too. Without `key`, or where the table is small, one task reads all.
    """
    if key is None:
        return _read(spark, options, dbtable=_quoted(table))
    figures = f"SELECT MIN({_quoted(key)}) AS least, MAX({_quoted(key)}) AS most, COUNT(*) AS n FROM {_quoted(table)}"
    least, most, n = _read(spark, options, query=figures).first()
    tasks = min(MAX_TASKS, -(-n // rows_per_task))
    if least is None or tasks < 2 or least == most:
        return _read(spark, options, dbtable=_quoted(table))
    return _read(spark, options, dbtable=_quoted(table), partitionColumn=_quoted(key), lowerBound=str(least), upperBound=str(most), numPartitions=str(tasks))


def _read(spark: SparkSession, options: dict[str, str], **more: str) -> DataFrame:
    return spark.read.format("jdbc").options(**(options | more)).load()


def insert_jdbc(new: DataFrame, options: dict[str, str], table: str, key: str = "product_url", order: tuple[str, ...] = ("page_id", "pos")) -> tuple[int, int]:
    """Appends the first row of each key by `order`; (rows that are now there, rows of these that were appended).

    `table` has a unique `key`. Executors write the rows to a table of this load's own in the database, which then takes
    over those whose key isn't there yet, by one statement in one transaction. Rows that a repeated task wrote
    twice are there once. Where another load takes a key meanwhile, the statement is repeated, and finds it taken.
    A load that fails has added nothing, and can be repeated. Rows whose key is null are left out.
    """
    spark = new.sparkSession
    rows = first_of_each(new.where(F.col(key).isNotNull()), key, order)
    columns, k = ", ".join(_quoted(c) for c in rows.columns), _quoted(key)
    # null texts travel as empty ones and a mark: not all databases take a null text for a column of bounded length
    texts = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string"]
    marks = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in texts], F.lit("")).alias("nulls")
    sent = rows.select(*[F.coalesce(c, F.lit("")).alias(c) if c in texts else F.col(c) for c in rows.columns], marks)
    values = ", ".join(f"CASE WHEN SUBSTR(s.\"nulls\", {texts.index(c) + 1}, 1) = '0' THEN s.{_quoted(c)} END" if c in texts else f"s.{_quoted(c)}" for c in rows.columns)
    own, target = _quoted(f"load_{uuid.uuid4().hex}"), _quoted(table)
    with _connection(spark, options) as connection:
        _run(connection, f"CREATE TABLE {own} AS SELECT {columns} FROM {target} WITH NO DATA")
        try:
            _run(connection, f'ALTER TABLE {own} ADD COLUMN "nulls" VARCHAR({len(texts) + 1})')
            _run(connection, f'ALTER TABLE {own} ADD COLUMN "row_no" BIGINT GENERATED ALWAYS AS IDENTITY')
            sent.write.format("jdbc").options(**options).option("dbtable", own).mode("append").save()
            first = f'(SELECT MIN("row_no") AS "row_no" FROM {own} GROUP BY {k}) f'
            absent = f"NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{k} = s.{k})"
            insert = f'INSERT INTO {target} ({columns}) SELECT {values} FROM {own} s JOIN {first} ON s."row_no" = f."row_no" WHERE {absent}'
            added = _until_no_key_is_taken(connection, insert)
            saved = _read(spark, options, query=f"SELECT COUNT(DISTINCT {k}) AS n FROM {own}").first()[0]
        finally:
            _run(connection, f"DROP TABLE {own}")
    return saved, added


def _until_no_key_is_taken(connection: Any, sql: str) -> int:
    while True:
        try:
            return _run(connection, sql)
        except Py4JJavaError as e:
            if not hasattr(e.java_exception, "getSQLState") or e.java_exception.getSQLState() != KEY_TAKEN:
                raise
