"""The same work as a bounded stream: new page files in, new product rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.products import to_product_rows
from ..plans.ladder import listing_products
from ..plans.queue_run import KEYS
from ..schemas import PAGES, PRODUCT_ROWS
from ..sources.keyed_table import KeyedTable
from ..sources.staged import staged


def product_table(spark: SparkSession, folder: str) -> KeyedTable:
    """The product table in a folder; a row a product_url."""
    return KeyedTable(spark, folder, PRODUCT_ROWS, "product_url")


def load_products(pages: DataFrame, table: KeyedTable, name: str | None = None) -> None:
    """Appends the rows of new products; pages delivered again add nothing, as rows are known by their url. A load of a
    `name` counts once."""
    pages = staged(pages.dropDuplicates(["page_id"]), "micro_batch")
    products = listing_products(pages)
    blank = F.lit(None).cast("bigint")
    owner = pages.select("page_id", F.col("url").alias("platform_url"), blank.alias("product_type_id"), blank.alias("searched_product_id"))
    table.insert(to_product_rows(products.join(owner, "page_id"), *KEYS), order=KEYS, name=name)


def stream_products(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint: str, max_files: int = 16) -> StreamingQuery:
    """Reads what page files are there, `max_files` at a time, and ends. To be read by product_table(out_dir).rows().

    Exactly once: a batch's rows show when its commit, named by stream and batch, is in the table's log. A batch that fails
    on the way leaves nothing; started again from its checkpoint, the stream does it anew, or passes over it if only the
    checkpoint's own note was lost.
    """
    pages = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", max_files).parquet(pages_dir)
    table = product_table(spark, out_dir)

    def load(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext._jsc.sc().getLocalProperty("sql.streaming.queryId")  # the same after a restart
        load_products(batch, table, f"{stream}/{number}")

    return pages.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
