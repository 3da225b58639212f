import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyweb.operators import jobs as j
from tallyweb.plans import queue_run
from tallyweb.plans.queue_run import process_queue
from tallyweb.schemas import CANDIDATES, OUTCOMES, PRODUCT_ROWS, QUEUE
from tallyweb.sources.tables import insert_if_absent, load_queue, write_queue

AT = datetime(2024, 5, 1)


def row(i, status="pending", retry=0, claimed=None):
    return (i, 1, f"https://a.com/{i}", status, retry, claimed, None, None, None, None, "old", None, None)


def test_status_filters():
    assert j.parse_status_filters(" Pending , failed,") == ["pending", "failed"]
    assert j.parse_status_filters(None) == j.parse_status_filters(" , ") == ["pending", "retrying"]


def test_claims(spark):
    queue = spark.createDataFrame([row(3), row(1), row(2, claimed="x"), row(4, "completed"), row(5, "retrying")], QUEUE)
    assert [r["id"] for r in j.claim_batch(queue, 2, ["pending", "retrying"], "w", AT).collect()] == [1, 3]
    assert [r["id"] for r in j.claim_batch(queue, 9, ["pending", "retrying"], "w", AT, 3).collect()] == [3, 5]
    assert j.claim_batch(queue, 0, ["pending"], "w", AT).count() == 0
    assert [r["id"] for r in load_queue(queue, offset=1).collect()] == [2, 3, 5]


@pytest.mark.parametrize("ids", ["even", "clusters", "widest", "one"])
def test_ids_at_places_by_counts(spark, ids):
    rnd = random.Random(3)
    known = {
        "even": range(-300, 700),
        "clusters": [rnd.choice([0, 10**6, 10**15, -(10**12)]) + rnd.randrange(300) for _ in range(900)],
        "widest": [-(2**63), 2**63 - 1, *(rnd.randrange(-(2**63), 2**63) for _ in range(500))],
        "one": [7] * 300,
    }[ids]
    df = spark.createDataFrame([(i,) for i in [*known, None]], "id long").repartition(3)
    want = sorted(known)
    for place in (0, 1, len(want) // 2, len(want) - 1):
        assert j.id_at(df, place, top_rows=5, ranges=16) == want[place]
    assert j.id_at(df, len(want), 5, 16) is None and j.id_at(df, -1, 5, 16) is None and j.id_at(df.limit(0), 0) is None


def test_deep_offsets_and_large_claims_sort_no_more_than_allowed(spark):
    queue = spark.createDataFrame([row(i * i, claimed="x" if i % 7 == 0 else None) for i in range(400)], QUEUE)
    deep = load_queue(queue, limit=100, offset=200, top_rows=30)
    assert [r["id"] for r in deep.collect()] == [i * i for i in range(200, 300)]
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan and "PushedFilters" not in plan
    assert [r["id"] for r in load_queue(queue, limit=100, offset=350, top_rows=30).collect()] == [i * i for i in range(350, 400)]
    assert load_queue(queue, limit=100, offset=400, top_rows=30).count() == 0
    assert [r["id"] for r in load_queue(queue, limit=60, top_rows=30).collect()] == [i * i for i in range(60)]
    assert [r["id"] for r in j.start_id(queue, ["pending"], 399, 30).collect()] == [399 * 399] and j.start_id(queue, ["pending"], 400, 30).count() == 0
    free = [i * i for i in range(400) if i % 7]
    assert sorted(r["id"] for r in j.claim_batch(queue, 100, ["pending"], "w", AT, 16, 30).collect()) == [i for i in free if i >= 16][:100]
    assert j.claim_batch(queue, 1000, ["pending"], "w", AT, top_rows=30).count() == len(free)


@pytest.mark.parametrize(
    ("kind", "success", "retry", "status", "after"),
    [
        ("result", True, 0, "completed", 1), ("result", False, 0, "retrying", 1), ("result", False, 1, "retrying", 2), ("result", False, 2, "failed", 3),
        ("raised", None, 2, "retrying", 3), ("raised", None, 3, "failed", 4), ("exhausted", None, 3, "failed", 3), ("exhausted", None, 0, "retrying", 1),
    ],
)
def test_states(spark, kind, success, retry, status, after):
    r = j.next_state(spark.createDataFrame([(1, kind, success, 2, 1, "e", retry, 3)], OUTCOMES)).first()
    assert (r["new_status"], r["new_retry_count"]) == (status, after)


def test_a_success_keeps_the_old_error_and_clears_the_claim(spark):
    queue = spark.createDataFrame([row(1, claimed="w"), row(2, claimed="w")], QUEUE)
    states = j.next_state(spark.createDataFrame([(1, "result", True, 2, 1, None, 0, 3)], OUTCOMES))
    got = {r["id"]: r for r in write_queue(queue, j.queue_update(states, AT)).collect()}
    assert (got[1]["processing_status"], got[1]["error_message"], got[1]["claimed_by"], got[1]["products_found"]) == ("completed", "old", None, 2)
    assert (got[2]["processing_status"], got[2]["claimed_by"]) == ("pending", "w")


def test_a_job_without_url_is_an_error(spark):
    with pytest.raises(Exception, match="no url"):
        j.normalize_jobs(spark.createDataFrame([(None, 1)], "url string, id long")).collect()


def test_insert_twice_is_once(spark):
    new = spark.createDataFrame([(1, [1], "u", "a"), (1, [2], "u", "b"), (2, [1], "v", "c")], "page_id long, pos array<bigint>, product_url string, product_name string")
    none = spark.createDataFrame([], "product_url string, product_name string")
    once = insert_if_absent(new, none)
    assert sorted(map(tuple, once.collect())) == [("u", "a"), ("v", "c")]
    assert insert_if_absent(new, once).count() == 0
    assert PRODUCT_ROWS.names[0] == "platform_url"


def test_batches_add_up_to_one(spark, monkeypatch):
    """Small batches, with rows that are tried again between new ones, give what one large batch gives."""

    def one_product(pages, max_items):
        known = {"page_id": F.col("page_id"), "rung": F.lit(1), "pos": F.array(F.lit(0)), "title": F.lit("Lamp"), "product_url": F.concat(F.lit("https://a.com/product/"), F.regexp_extract("html", "[0-9]", 0))}
        return pages.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANDIDATES.fields])

    monkeypatch.setattr(queue_run, "listing_products", one_product)
    html = "<p>Lamp {0}"
    pages = spark.createDataFrame([(i, f"https://a.com/{i}", html.format(i % 3)) for i in (1, 2, 4, 7)], "page_id long, url string, html string")
    queue = spark.createDataFrame([row(i, "retrying" if i % 2 else "pending", i % 4, "x" if i == 3 else None) for i in range(1, 9)], QUEUE)
    none = spark.createDataFrame([], PRODUCT_ROWS)
    runs = [process_queue(queue, pages, none, AT, batch_size=n) for n in (3, 100_000)]
    states = [sorted((r["id"], r["processing_status"], r["retry_count"], r["claimed_by"], r["success"], r["error_message"]) for r in run.queue.collect()) for run in runs]
    assert states[0] == states[1] and len(states[0]) == 8 and runs[0].batches > runs[1].batches > 1
    assert states[0][2][1:4] == ("retrying", 3, "x") and [s[4] for s in states[0]] == [True, True, None, True, False, False, True, False]
    for run in runs:
        assert sorted(r["product_url"] for r in run.products.collect()) == [f"https://a.com/product/{i}" for i in (1, 2)]
        stats = run.stats.first()
        assert (stats["submitted"], stats["succeeded"], run.results.count()) == (run.results.count(), 4, stats["submitted"])
    assert process_queue(queue.limit(0), pages, none, AT).batches == 0
    big = spark.createDataFrame([row(i) for i in range(10_050)], QUEUE)
    assert [tuple(r) for r in j.claim_batch(big, 10_020, ["pending"], "w", AT).selectExpr("count(*)", "max(id)").collect()] == [(10_020, 10_019)]
