"""Rows that joins may need are told before they are shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from tallyweb.llm import ngram_join
from tallyweb.llm.ngram_join import near_duplicates

DOCS = "doc_id long, text string"


def shuffled_mb(spark, run):
    """MB that stages write to shuffles while `run` runs."""
    store = spark.sparkContext._jsc.sc().statusStore()
    rest = [getattr(store, f"stageList$default${i}")() for i in range(2, 6)]

    def stages():
        found = store.stageList(None, *rest)
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (found.apply(i) for i in range(found.size()))}

    before = stages()
    out = run()
    return sum(v for k, v in stages().items() if k not in before) / 1e6, out


@pytest.fixture
def no_small_tables(spark):
    """Tables of tests would be broadcast, those of real size aren't."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, was)


def random_text(rnd, n):
    return " ".join(f"{rnd.getrandbits(64):x}" for _ in range(n))


def test_texts_without_candidates_are_not_shuffled(spark, no_small_tables):
    rnd = random.Random(5)
    rows = [(i, random_text(rnd, 1500)) for i in range(400)]
    rows += [(1000, rows[0][1] + " more"), (1001, rows[0][1]), (None, rows[7][1] + " more")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4).persist()
    docs.count()
    mb, got = shuffled_mb(spark, lambda: {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates(docs).collect()})
    docs.unpersist()
    linked = {0: (0, 2), 1000: (0, 2), 1001: (0, 2), 7: (7, 1), None: (7, 1)}
    assert got == {i: (i, 0) for i in range(400)} | linked
    assert mb < 3  # all texts are 10 MB


def test_sets_outside_large_buckets_are_not_shuffled_again(spark, no_small_tables, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET", 16)
    rnd = random.Random(6)
    shared = random_text(rnd, 150)
    rows = [(i, random_text(rnd, 150)) for i in range(4000)] + [(5000 + i, shared + " " + random_text(rnd, 100)) for i in range(40)]
    rows += [(6000, rows[-1][1] + " more")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4).persist()
    docs.count()
    by_stage, stage = {}, ngram_join.staged

    def measured(df, name):
        by_stage[name], out = shuffled_mb(spark, lambda: stage(df, name))
        return out

    monkeypatch.setattr(ngram_join, "staged", measured)
    got = {r["doc_id"]: r["n_links"] for r in near_duplicates(docs).collect()}
    docs.unpersist()
    assert {k for k, v in got.items() if v} == {5039, 6000}
    # 4041 sets are 2 MB of tokens
    assert by_stage["nodes"] > 1.5 and by_stage["paths_2"] < 0.5 and by_stage["edges_2"] < 0.1


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_the_sieve_loses_no_wanted_row(spark, kind):
    from tallyweb.llm.sieve import sieved

    ids = spark.range(-20_000, 20_000).select(F.when(F.col("id") != 5, F.col("id")).cast(kind).alias("k"), F.lit("x").alias("bits"))
    wanted = ids.where("k IS NULL OR CAST(k AS long) % 100 = 0").select(F.col("k").alias("bucket"))
    kept = sieved(ids.unionByName(ids), "k", wanted, "bucket")
    both = kept.join(wanted, kept["k"].eqNullSafe(wanted["bucket"]))
    assert both.count() == 802 and 802 <= kept.count() < 900 and kept.columns == ["k", "bits"]
    assert sieved(ids, "k", wanted.limit(0), "bucket").count() == 0
