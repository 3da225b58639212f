"""From the work queue to the product table, batch after batch. Each batch is a few Spark jobs; the driver holds no rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed
from ..operators import jobs as j
from ..operators.products import to_product_rows
from ..schemas import PRODUCT_ROWS, QUEUE
from ..sources.keyed_table import KeyedTable
from ..sources.queue_log import QueueLog
from ..sources.staged import staged, staged_dir
from ..sources.tables import write_queue
from .ladder import listing_products, page_results

KEYS = ("page_id", "pos")
COMPACT_AFTER = 16  # batches


@dataclass
class Run:
    queue: DataFrame
    products: DataFrame
    results: DataFrame | None
    stats: DataFrame | None
    batches: int


def run_jobs(jobs: DataFrame, pages: DataFrame, max_items: int = fixed.MAX_ITEMS) -> tuple[DataFrame, DataFrame | None]:
    """(results of the jobs, rows for the product table with KEYS, or none if no job has a page).

    A page that several jobs name is read once; its products go to the job of the least url_id.
    """
    attached = staged(j.attach_pages(jobs, pages), "attached")
    found = attached.where("page_id IS NOT NULL").groupBy("page_id").agg(
        F.min_by(F.struct("url", "html", "product_type_id", "searched_product_id"), F.coalesce("url_id", F.lit(0))).alias("p")
    )
    found = staged(found.select("page_id", "p.*"), "batch_pages")
    if found.isEmpty():  # nothing to read: all of them fail
        results = attached.select("url", "url_id", "retry_count", "max_retries", "page_id", "error").withColumns(
            {"success": F.lit(False), "num_products": F.lit(None).cast("bigint"), "saved_to_db": F.lit(None).cast("bigint"), "kind": F.lit("result")}
        )
        return results, None
    products = staged(listing_products(found, max_items), "batch_products")
    results = page_results(found, products).select("page_id", "success", "num_products", "saved_to_db")
    results = attached.select("url", "url_id", "retry_count", "max_retries", "page_id", "error").join(results, "page_id", "left")
    results = results.withColumns({"kind": F.lit("result"), "success": F.coalesce("success", F.lit(False))})
    owner = found.select("page_id", F.col("url").alias("platform_url"), "product_type_id", "searched_product_id")
    rows = to_product_rows(products.join(owner, "page_id"), *KEYS)
    return results, rows


def process_queue(
    queue: DataFrame,
    pages: DataFrame,
    existing: DataFrame,
    at: datetime,
    batch_size: int = 1000,
    limit: int | None = None,
    statuses: list[str] | None = None,
    offset: int = 0,
    worker: str = "worker",
    max_retries: int = fixed.MAX_RETRIES,
) -> Run:
    """Claims, runs and updates until `limit` rows are done or none can be claimed.

    Rows to be tried again can be claimed again in the same run. It ends, as each failure raises retry_count, and no row
    stays claimable past the limit of retries. The queue is a log of its own here, see work_on().
    """
    folder = f"{staged_dir(queue.sparkSession)}/queue-run-{uuid.uuid4().hex}"
    statuses = statuses or list(fixed.QUEUE_STATUSES)
    first = j.start_id(queue, statuses, offset).first() if offset else None
    log = QueueLog.create(queue, f"{folder}/queue", max(batch_size, j.TOP_ROWS))
    table = KeyedTable(queue.sparkSession, f"{folder}/products", PRODUCT_ROWS, "product_url")
    table.insert(existing.select(*PRODUCT_ROWS.names))
    run = work_on(log, pages, table, at, folder, batch_size, limit, statuses, first["id"] if first else None, worker, max_retries)
    if not run.batches:
        return Run(queue, existing, None, None, 0)
    # rows of the target that share a key were there before, and stay
    new = table.rows().join(existing.select("product_url"), "product_url", "left_anti").select(*PRODUCT_ROWS.names)
    return Run(run.queue, existing.select(*PRODUCT_ROWS.names).unionByName(new), run.results, run.stats, run.batches)


def work_on(
    log: QueueLog,
    pages: DataFrame,
    table: KeyedTable,
    at: datetime,
    folder: str,
    batch_size: int = 1000,
    limit: int | None = None,
    statuses: list[str] | None = None,
    min_id: int | None = None,
    worker: str = "worker",
    max_retries: int = fixed.MAX_RETRIES,
) -> Run:
    """One worker of those that share `log` and the target `table`: claims, runs and updates batch after batch.

    A batch reads the parts of the queue that it claims from, and the parts of the target that its products may be in. Its
    results and statistics are appended to tables of this worker's own `folder`. A worker that dies leaves its batch
    claimed, as other workers can't know; what it had not committed is not there.
    """
    spark = log.spark
    statuses = statuses or list(fixed.QUEUE_STATUSES)
    done = batches = 0
    kinds: dict[str, StructType] = {}

    def append(df: DataFrame, name: str) -> None:
        kinds[name] = df.schema
        df.write.mode("append").parquet(f"{folder}/{name}")

    def so_far(name: str) -> DataFrame:
        return spark.read.schema(kinds[name]).parquet(f"{folder}/{name}")

    while limit is None or done < limit:
        n = batch_size if limit is None else min(batch_size, limit - done)
        claimed = log.claim(n, statuses, f"{worker}-{batches}", at, min_id)
        taken = claimed.count()
        if not taken:
            break
        jobs = j.normalize_jobs(
            claimed.select(F.col("product_page_url").alias("url"), F.col("id").alias("url_id"), "retry_count", "product_type_id"), max_retries=max_retries
        )
        outcome, rows = run_jobs(jobs, pages)
        outcome = staged(outcome, "outcomes")
        if rows is not None:
            table.insert(rows, order=KEYS)
        after = write_queue(claimed, j.queue_update(j.next_state(outcome), at))
        log.update(after.join(claimed.select("id", "part"), "id"), f"{worker}-{batches}")
        append(outcome, "results")
        append(j.run_stats(outcome), "stats")
        done, batches = done + taken, batches + 1
        if batches % COMPACT_AFTER == 0:
            log.compact()
            table.compact()
    if not batches:
        return Run(log.state(), table.rows(), None, None, 0)
    return Run(log.state(), table.rows(), so_far("results"), j.rollup_batches(so_far("stats")), batches)
