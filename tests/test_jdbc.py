"""Reads and loads by JDBC, on the Derby that ships with Spark (in memory, in this process)."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from tallyweb.schemas import QUEUE
from tallyweb.sources.jdbc import _connection, _run, insert_jdbc, read_jdbc
from tallyweb.sources.tables import load_queue

NEW = "page_id long, pos int, product_url string, product_name string, current_price double"


@pytest.fixture
def options():
    return {"url": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"}


def run(spark, options, *statements):
    with _connection(spark, options) as connection:
        return [_run(connection, s) for s in statements]


def product_table(spark, options, *urls):
    run(
        spark,
        options,
        'CREATE TABLE "products" ("product_url" VARCHAR(500) NOT NULL PRIMARY KEY, "product_name" VARCHAR(500), "current_price" DOUBLE, "added" INT DEFAULT 7)',
        *[f"INSERT INTO \"products\" (\"product_url\", \"product_name\") VALUES ('{u}', 'old')" for u in urls],
    )


def products(spark, options):
    return {r["product_url"]: r for r in read_jdbc(spark, options, "products").collect()}


def test_a_queue_is_read_by_ranges_with_its_filters_pushed(spark, options):
    state = ["pending", "retrying", "completed"]
    rows = [(i, 1, f"https://a.com/{i}", state[i % 3], 0, None, None, None, None, None, None, None, None) for i in range(-40, 960)]
    queue = spark.createDataFrame(rows, QUEUE).drop("claimed_at", "processed_at", "updated_at", "success")
    queue.write.format("jdbc").options(**options).option("dbtable", '"queue"').option("createTableColumnTypes", "processing_status VARCHAR(20)").save()
    got = read_jdbc(spark, options, "queue", "id", rows_per_task=100)
    sizes = got.rdd.glom().map(len).collect()
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= 110
    assert sorted(r["id"] for r in got.collect()) == list(range(-40, 960))
    some = got.where("processing_status IN ('pending', 'retrying') AND id >= 900")
    scan = next(x for x in some._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in x)
    assert "In(processing_status, [pending,retrying])" in scan and "GreaterThanOrEqual(id,900)" in scan
    whole = got.withColumn("claimed_at", F.lit(None).cast("timestamp"))
    for top_rows in (10_000, 20):
        ids = [r["id"] for r in load_queue(whole, limit=200, offset=300, top_rows=top_rows).collect()]
        assert ids == [i for i in range(-40, 960) if i % 3 < 2][300:500]


def test_odd_tables_are_read_whole(spark, options):
    run(spark, options, 'CREATE TABLE "t" ("id" BIGINT, "x" VARCHAR(9))')
    assert read_jdbc(spark, options, "t", "id", rows_per_task=1).count() == 0
    run(spark, options, "INSERT INTO \"t\" VALUES (5, 'a'), (5, NULL)")
    assert read_jdbc(spark, options, "t", "id", rows_per_task=1).count() == 2
    run(spark, options, "INSERT INTO \"t\" VALUES (NULL, 'b'), (9, 'c')")
    got = read_jdbc(spark, options, "t", "id", rows_per_task=1)
    assert got.rdd.getNumPartitions() == 4 and sorted((r["id"] or 0, r["x"] or "") for r in got.collect()) == [(0, "b"), (5, ""), (5, "a"), (9, "c")]


def test_keys_that_are_there_count_as_saved(spark, options):
    product_table(spark, options, "u1", "u9")
    rows = [(1, 1, "u1", "new", 1.0), (2, 0, "u2", "late", 2.0), (1, 5, "u2", "first", 3.0), (1, 6, "u3", None, None), (1, 7, None, "x", 1.0)]
    new = spark.createDataFrame(rows, NEW).repartition(3)
    assert insert_jdbc(new, options, "products") == (3, 2)
    got = products(spark, options)
    assert {u: r["product_name"] for u, r in got.items()} == {"u1": "old", "u9": "old", "u2": "first", "u3": None}
    assert got["u2"]["current_price"] == 3.0 and got["u2"]["added"] == 7
    assert insert_jdbc(new, options, "products") == (3, 0)
    assert insert_jdbc(new.limit(0), options, "products") == (0, 0) and products(spark, options).keys() == got.keys()


def test_loads_at_once_take_each_key_once(spark, options):
    product_table(spark, options, "u5")
    told = {}

    def load(k):
        rows = [(1, i, f"u{i}", f"load {k}", 1.0) for i in range(k * 50, k * 50 + 150)]
        told[k] = insert_jdbc(spark.createDataFrame(rows, NEW), options, "products")

    threads = [threading.Thread(target=load, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [told[k][0] for k in range(3)] == [150] * 3 and sum(added for _, added in told.values()) == 249
    assert products(spark, options).keys() == {f"u{i}" for i in range(250)}


def test_a_load_that_fails_adds_nothing_and_leaves_no_table(spark, options):
    product_table(spark, options, "u1")
    too_long = spark.createDataFrame([(1, i, f"u{i}", "x" * (501 if i == 40 else 3), 1.0) for i in range(50)], NEW).repartition(4)
    with pytest.raises(Exception, match="(?i)truncat"):
        insert_jdbc(too_long, options, "products")
    assert products(spark, options).keys() == {"u1"}
    tables = spark.read.format("jdbc").options(**options).option("query", "SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'").load()
    assert [r[0] for r in tables.collect()] == ["products"]
