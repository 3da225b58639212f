"""The work queue: claiming, jobs, outcomes, states, and run statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import truncate

NO_PAGE = "no snapshot of the page"
TOP_ROWS = 10_000  # rows that one task may sort
RANGES = 1024  # of ids that are counted at once


def parse_status_filters(text: str | None) -> list[str]:
    given = [part.strip().lower() for part in (text or "").split(",")]
    return [s for s in given if s] or list(fixed.QUEUE_STATUSES)


def id_at(rows: DataFrame, place: int, top_rows: int = TOP_ROWS, ranges: int = RANGES) -> int | None:
    """The id at `place` (from 0) of all ids in order, or None if there are not as many. Null ids have no place.

    Ids are counted in `ranges` ranges of equal width, then in as many of the range that holds the place, and so on, until
    one task may sort what a range holds: a pass over the ids each time, with its range as a filter, and `ranges` counts
    to the driver. Seven passes do for any 64-bit ids, however they lie.
    """
    ids = rows.where(F.col("id").isNotNull()).select("id")
    low, high, n = ids.agg(F.min("id"), F.max("id"), F.count("*")).first()
    if place < 0 or place >= n:
        return None
    while n > top_rows and low < high:
        width = -(-(high - low + 1) // ranges)
        at = F.expr(f"(CAST(id AS DECIMAL(20, 0)) - CAST('{low}' AS DECIMAL(20, 0))) DIV CAST('{width}' AS DECIMAL(20, 0))")
        inside = ids.where(F.col("id").between(low, high))
        for r in sorted(inside.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect()):
            if place < r["n"]:
                low, high, n = low + r["at"] * width, min(high, low + (r["at"] + 1) * width - 1), r["n"]
                break
            place -= r["n"]
    if low == high:
        return low
    return ids.where(F.col("id").between(low, high)).orderBy("id").offset(place).limit(1).first()["id"]


def start_id(queue: DataFrame, statuses: list[str], offset: int, top_rows: int = TOP_ROWS) -> DataFrame:
    """The id at the offset, as a table of one row or none; one beyond `top_rows` rows is found by counts."""
    rows = queue.where(F.col("processing_status").isin(statuses))
    if offset < top_rows:
        return rows.orderBy("id").offset(offset).limit(1).select("id")
    found = id_at(rows, offset, top_rows)
    return queue.sparkSession.createDataFrame([] if found is None else [(found,)], "id long")


def claim_batch(
    queue: DataFrame, n: int, statuses: list[str], worker: str, at: datetime, min_id: int | None = None, top_rows: int = TOP_ROWS
) -> DataFrame:
    """Up to `n` rows of these statuses that nobody has claimed, the least ids first, stamped with worker and time.

    More than `top_rows` aren't sorted: the id after the last one is found by counts, and rows below it are claimed.
    """
    free = queue.where(F.col("processing_status").isin(statuses) & F.col("claimed_by").isNull())
    if min_id is not None:
        free = free.where(F.col("id") >= min_id)
    if n <= top_rows:
        free = free.orderBy("id").limit(max(0, n))
    elif (end := id_at(free, n, top_rows)) is not None:
        free = free.where(F.col("id") < end)
    return free.withColumns({"claimed_by": F.lit(worker), "claimed_at": F.lit(at)})


def normalize_jobs(jobs: DataFrame, max_items: int = fixed.MAX_ITEMS, wait_seconds: int = fixed.WAIT_SECONDS, max_retries: int = fixed.MAX_RETRIES) -> DataFrame:
    """Defaults filled in. url_id falls back on `id`. A row without url is an error when the row is read."""
    defaults = {"max_items": max_items, "wait_seconds": wait_seconds, "max_retries": max_retries, "retry_count": 0}
    has = set(jobs.columns)
    known = [F.col(c) for c in ("url_id", "id") if c in has]
    return jobs.select(
        F.coalesce("url", F.raise_error(F.lit("a job has no url")).cast("string")).alias("url"),
        (F.coalesce(*known) if known else F.lit(None)).cast("bigint").alias("url_id"),
        *[(F.coalesce(F.col(c), F.lit(v)) if c in has else F.lit(v)).cast("int").alias(c) for c, v in defaults.items()],
        *[(F.col(c) if c in has else F.lit(None)).cast("bigint").alias(c) for c in ("product_type_id", "searched_product_id")],
    )


def jobs_of_queue(claimed: DataFrame) -> DataFrame:
    return normalize_jobs(claimed.select(F.col("product_page_url").alias("url"), F.col("id").alias("url_id"), "retry_count", "product_type_id"))


def attach_pages(jobs: DataFrame, pages: DataFrame) -> DataFrame:
    """Jobs with their page; `error` tells of those without. Of several pages with one url the least page_id counts.

    Only pages whose address a job names are grouped.
    """
    named = pages.join(jobs.select("url").distinct(), "url", "left_semi")
    one = named.groupBy("url").agg(F.min_by(F.struct("page_id", "html"), "page_id").alias("page"))
    joined = jobs.join(one, "url", "left")
    return joined.select(*jobs.columns, "page.page_id", "page.html", F.when(F.col("page").isNull(), NO_PAGE).alias("error"))


def next_state(outcomes: DataFrame) -> DataFrame:
    """`outcomes` with new_status, new_retry_count, new_error, and what is stored of found and saved products.

    A result that failed is tried again while fewer than max_retries attempts were made; an exception while no more were.
    An exhausted worker's exception counts no attempt once the retries are used up.
    """
    kind, r, m = F.col("kind"), F.coalesce("retry_count", F.lit(0)), F.coalesce("max_retries", F.lit(fixed.MAX_RETRIES))
    done = (kind == "result") & F.coalesce("success", F.lit(False))
    failed = (kind == "result") & ~done
    skipped = (kind == "exhausted") & (r >= m)
    again = F.when(failed, (m > 0) & (r + 1 < m)).otherwise(r + 1 <= m)
    status = F.when(done, "completed").when(skipped, "failed").when(again, "retrying").otherwise("failed")
    error = F.when(skipped, F.concat(F.lit("Skipped after "), r.cast("string"), F.lit(" retries: "), F.coalesce("error", F.lit("")))).when(~done, F.col("error"))
    counted = done | (failed & ~again)
    return outcomes.select(
        "*",
        status.alias("new_status"),
        F.when(skipped, r).otherwise(r + 1).cast("int").alias("new_retry_count"),
        done.alias("new_success"),
        error.alias("new_error"),
        F.when(skipped, 0).when(counted, F.col("num_products")).cast("bigint").alias("new_found"),
        F.when(skipped, 0).when(counted, F.col("saved_to_db")).cast("bigint").alias("new_saved"),
    )


def queue_update(states: DataFrame, at: datetime) -> DataFrame:
    """Changes to queue rows, by id; a null leaves a column as it is, but for the claim, which is always cleared."""
    now = F.lit(at)
    return states.where("url_id IS NOT NULL").select(
        F.col("url_id").alias("id"),
        F.col("new_status").alias("processing_status"),
        F.col("new_retry_count").alias("retry_count"),
        F.col("new_success").alias("success"),
        F.col("new_found").alias("products_found"),
        F.col("new_saved").alias("products_saved"),
        truncate(F.col("new_error"), fixed.ERROR_CHARS).alias("error_message"),
        F.when(F.col("new_status").isin("completed", "failed"), now).alias("processed_at"),
        now.alias("updated_at"),
    )


def _sum(c: Column, name: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)


STATS = ["submitted", "succeeded", "failed", "total_products_found", "total_saved_to_db"]


def run_stats(results: DataFrame) -> DataFrame:
    ok = F.coalesce("success", F.lit(False))
    return results.agg(
        F.count("*").alias("submitted"),
        _sum(F.when(ok, 1), "succeeded"),
        _sum(F.when(~ok, 1), "failed"),
        _sum(F.when(ok, F.col("num_products")), "total_products_found"),
        _sum(F.when(ok, F.col("saved_to_db")), "total_saved_to_db"),
    )


def rollup_batches(stats: DataFrame) -> DataFrame:
    return stats.agg(*[_sum(F.col(c), c) for c in STATS])


def result_samples(results: DataFrame, n: int = 5) -> DataFrame:
    """The first n successes and the first n failures by url_id."""
    ok = F.coalesce("success", F.lit(False))
    at = Window.partitionBy("__ok").orderBy("url_id")
    picked = results.withColumn("__ok", ok).withColumn("place", F.row_number().over(at)).where(F.col("place") <= n)
    return picked.select(
        F.col("__ok").alias("success"),
        "place",
        "url_id",
        F.when(F.col("__ok"), F.coalesce("num_products", F.lit(0))).cast("bigint").alias("num_products"),
        F.when(F.col("__ok"), F.coalesce("saved_to_db", F.lit(0))).cast("bigint").alias("saved_to_db"),
        F.when(~F.col("__ok"), F.coalesce("error", F.lit("unknown error"))).alias("error"),
    )


def sample_jobs(jobs: DataFrame, n: int = 3) -> DataFrame:
    return jobs.orderBy("pos").limit(n)
