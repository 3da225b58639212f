"""Commit logs, the queue's log, the keyed table, and the stream: several at once, failing halfway, reading little."""

import shutil
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyweb.plans import queue_run
from tallyweb.schemas import CANDIDATES, PRODUCT_ROWS, QUEUE
from tallyweb.sources.commit_log import CommitLog
from tallyweb.sources.keyed_table import KeyedTable
from tallyweb.sources.queue_log import QueueLog
from tallyweb.streaming import stream

AT = datetime(2024, 5, 1)


def queue_of(spark, rows):
    return spark.createDataFrame([(i, 1, f"https://a.com/{i}", status, retry, claimed, None, None, None, None, None, None, None) for i, status, retry, claimed in rows], QUEUE)


def test_a_number_goes_to_one_writer(spark, tmp_path):
    logs = [CommitLog(spark, f"file://{tmp_path}/log") for _ in range(6)]

    def write(log):
        won = 0
        while won < 5:
            won += log.put(len(log.entries()), {"by": id(log)})
        return won

    with ThreadPoolExecutor(6) as pool:
        assert sum(pool.map(write, logs)) == 30
    entries = CommitLog(spark, f"file://{tmp_path}/log").entries()
    assert sorted(entries, key=lambda e: e["by"]) == sorted([{"by": id(x)} for x in logs for _ in range(5)], key=lambda e: e["by"])
    assert not logs[0].put(3, {}) and [p for p in (tmp_path / "log").iterdir() if not p.name.endswith((".json", ".crc"))] == []


def test_rename_takes_a_free_place_only(spark, tmp_path):
    """The other way to commit, of stores with such a rename."""
    log = CommitLog(spark, f"file://{tmp_path}/log")
    for name, text in (("a", "1"), ("b", "2")):
        (tmp_path / "log" / name).write_text(text)
    assert log._rename(f"{log.folder}/a", f"{log.folder}/c")
    assert not log._rename(f"{log.folder}/b", f"{log.folder}/c") and (tmp_path / "log" / "c").read_text() == "1"


def test_claims_updates_and_compaction(spark, tmp_path):
    rows = [(i, ("pending", "retrying", "completed")[i % 3], 0, "x" if i == 4 else None) for i in range(1, 41)]
    log = QueueLog.create(queue_of(spark, rows), f"file://{tmp_path}/q", rows_per_part=10)
    open_ids = [i for i in range(1, 41) if i % 3 < 2 and i != 4]
    ids = lambda df: sorted(r["id"] for r in df.collect())
    first = log.claim(7, ["pending", "retrying"], "w", AT)
    assert ids(first) == open_ids[:7] and {r["claimed_by"] for r in first.collect()} == {"w"}
    assert ids(log.claim(3, ["retrying"], "w", AT, min_id=20)) == [22, 25, 28]
    log.update(first.withColumns({"processing_status": F.when(F.col("id") % 2 == 0, "completed").otherwise("retrying"), "claimed_by": F.lit(None).cast("string"), "retry_count": F.lit(1)}), "w")
    before = sorted(map(tuple, log.state().collect()))
    log.compact()
    log.compact()
    assert sorted(map(tuple, log.state().collect())) == before and len(before) == 40
    again = [i for i in open_ids[:7] if i % 2]
    rest = [i for i in open_ids[7:] if i not in (22, 25, 28)]
    assert ids(log.claim(1000, ["pending", "retrying"], "v", AT)) == sorted(again + rest)
    assert log.claim(5, ["pending", "retrying"], "v", AT).count() == 0 and log.claim(0, ["completed"], "v", AT).count() == 0
    assert QueueLog.create(queue_of(spark, rows[:1]).limit(0), f"file://{tmp_path}/none").claim(5, ["pending"], "w", AT).count() == 0
    with pytest.raises(ValueError, match="a log already"):
        QueueLog.create(queue_of(spark, rows), f"file://{tmp_path}/q")


def test_compaction_keeps_what_comes_meanwhile(spark, tmp_path, monkeypatch):
    log = QueueLog.create(queue_of(spark, [(i, "pending", 0, None) for i in range(20)]), f"file://{tmp_path}/q", rows_per_part=5)
    log.claim(6, ["pending"], "a", AT)
    other, write = QueueLog(spark, log.folder), QueueLog._write

    def slow(self, rows, claimed=False):
        out = write(self, rows, claimed)
        if self is log:
            monkeypatch.setattr(QueueLog, "_write", write)
            assert sorted(r["id"] for r in other.claim(3, ["pending"], "b", AT).collect()) == [6, 7, 8]
        return out

    monkeypatch.setattr(QueueLog, "_write", slow)
    log.compact()
    assert [e["kind"] for e in log.log.entries()] == ["base", "claim", "claim", "base"]
    assert sorted(r["id"] for r in log.state().where("claimed_by IS NOT NULL").collect()) == list(range(9))
    assert sorted(r["id"] for r in log.claim(2, ["pending"], "c", AT).collect()) == [9, 10]


def test_a_claim_reads_the_parts_it_takes_from(spark, tmp_path):
    log = QueueLog.create(queue_of(spark, [(i, "pending", 0, None) for i in range(400)]), f"file://{tmp_path}/q", rows_per_part=50)
    base = log.log.entries()[0]
    assert len(base["parts"]) == 8
    for part in (tmp_path / "q" / "rows").glob("*/part=*"):
        if int(part.name[5:]) > 1:  # what isn't read may as well be gone
            shutil.rmtree(part)
    first = sum(n for p in ("0", "1") for n, *_ in base["parts"][p].values())
    assert log.claim(first, ["pending"], "w", AT).count() == first


def one_product(pages, max_items):
    known = {"page_id": F.col("page_id"), "rung": F.lit(1), "pos": F.array(F.lit(0)), "title": F.lit("Lamp"), "product_url": F.concat(F.lit("https://a.com/product/"), F.regexp_extract("html", "[0-9]", 0))}
    return pages.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANDIDATES.fields])


def test_two_workers_do_each_row_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queue_run, "listing_products", one_product)
    monkeypatch.setattr(queue_run, "COMPACT_AFTER", 2)
    pages = spark.createDataFrame([(i, f"https://a.com/{i}", f"<p>Lamp {i % 4}") for i in range(12)], "page_id long, url string, html string")
    log = QueueLog.create(queue_of(spark, [(i, "pending", 2 if i >= 12 else 0, None) for i in range(20)]), f"file://{tmp_path}/q", rows_per_part=6)
    table = KeyedTable(spark, f"file://{tmp_path}/products", PRODUCT_ROWS, "product_url", parts=3)

    def work(name):
        return queue_run.work_on(QueueLog(spark, log.folder), pages, KeyedTable(spark, table.folder, PRODUCT_ROWS, "product_url"), AT, f"file://{tmp_path}/{name}", batch_size=4, worker=name)

    with ThreadPoolExecutor(2) as pool:
        runs = list(pool.map(work, ["a", "b"]))
    claims = log.history().where("kind = 'claim'").collect()
    assert sorted(r["id"] for r in claims) == list(range(20))
    assert sum(run.batches for run in runs) == len({r["worker"] for r in claims}) >= 5
    done = {r["id"]: (r["processing_status"], r["claimed_by"]) for r in QueueLog(spark, log.folder).state().collect()}
    assert done == {i: ("completed" if i < 12 else "failed", None) for i in range(20)}
    assert sorted(r["product_url"] for r in table.rows().collect()) == [f"https://a.com/product/{i}" for i in range(4)]


KV = "k string, v int"


def test_keyed_table(spark, tmp_path):
    df = lambda rows: spark.createDataFrame(rows, KV)
    t = KeyedTable(spark, f"file://{tmp_path}/t", df([]).schema, "k", parts=8, bits=1 << 12)
    got = lambda: sorted(((r["k"] or ""), r["v"]) for r in t.rows().collect())
    assert t.insert(df([])).count() == 0 and got() == []
    assert t.insert(df([("a", 2), ("a", 1), ("b", 1), (None, 5)]), order=("v",)).count() == 3
    assert t.insert(df([("a", 0), ("c", 3), (None, 4)]), name="x").count() == 1
    assert sorted(map(tuple, t.insert(df([("d", 9)]), name="x").collect())) == [("c", 3)]  # done before: does nothing
    t.compact()
    assert sorted(map(tuple, t.insert(df([("d", 9)]), name="x").collect())) == [("c", 3)]
    assert t.insert(df([(x, 7) for x in "abcde"])).count() == 2
    assert got() == [("", 5), ("a", 1), ("b", 1), ("c", 3), ("d", 7), ("e", 7)]


def test_an_insert_reads_the_parts_its_keys_may_be_in(spark, tmp_path):
    df = spark.range(4000).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("k"), F.col("id").cast("int").alias("v"))
    t = KeyedTable(spark, f"file://{tmp_path}/t", df.schema, "k", parts=32, bits=1 << 14)
    t.insert(df)
    few = df.where("v IN (7, 8)").withColumn("v", F.lit(-1)).unionByName(spark.createDataFrame([(f"new{i}", i) for i in range(20)], KV))
    known = sorted(r["p"] for r in few.where("v = -1").select(F.pmod(F.xxhash64("k"), F.lit(32)).cast("int").alias("p")).distinct().collect())
    for part in (tmp_path / "t" / "rows").glob("*/part=*"):
        if int(part.name[5:]) not in known:  # what isn't read may as well be gone
            shutil.rmtree(part)
    assert t.insert(few).count() == 20
    assert t.log.entries()[-1]["read"] == known


def test_writers_of_one_table_do_not_write_a_key_twice(spark, tmp_path):
    schema = spark.createDataFrame([], KV).schema
    KeyedTable(spark, f"file://{tmp_path}/t", schema, "k", parts=2)

    def write(i):
        return KeyedTable(spark, f"file://{tmp_path}/t", schema, "k").insert(spark.createDataFrame([("same", i), (f"own{i}", i)], KV)).count()

    with ThreadPoolExecutor(3) as pool:
        assert sum(pool.map(write, range(3))) == 4
    assert KeyedTable(spark, f"file://{tmp_path}/t", schema, "k").rows().count() == 4


def test_a_stream_that_fails_halfway_goes_on(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"https://a.com/{i}", f"<p>Lamp {i}") for i in range(9)], "page_id long, url string, html string")
    pages.repartition(3, "page_id").write.parquet(f"{tmp_path}/pages")
    monkeypatch.setattr(stream, "listing_products", lambda pages: one_product(pages, 50))
    load, made, tries = stream.load_products, [], []

    def failing(batch, table, name):
        tries.append(name)
        if len(tries) == 2:  # after the rows are written, before they count
            monkeypatch.setattr(CommitLog, "put", lambda *_: 1 / 0)
        load(batch, table, name)
        made.append(name)
        if len(tries) == 4:  # after they count, before the stream knows
            raise RuntimeError("lost")

    monkeypatch.setattr(stream, "load_products", failing)
    put = CommitLog.put
    out, go = f"file://{tmp_path}/out", lambda: stream.stream_products(spark, f"{tmp_path}/pages", out, f"{tmp_path}/checkpoint", max_files=1).awaitTermination()
    for _ in range(2):
        with pytest.raises(Exception, match="ZeroDivisionError|lost"):
            go()
        monkeypatch.setattr(CommitLog, "put", put)
    go()
    rows = stream.product_table(spark, out).rows()
    assert rows.count() == rows.select("product_url").distinct().count() == 9
    assert len(set(tries)) < len(tries) and len({t.split("/")[0] for t in tries}) == 1 and Path(tmp_path / "out").exists()
