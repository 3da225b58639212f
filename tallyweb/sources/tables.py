"""Tables read and written: page snapshots, the product table, the work queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.jobs import TOP_ROWS, id_at
from ..schemas import PAGES, QUEUE


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def load_queue(
    queue: DataFrame, statuses: list[str] | None = None, limit: int | None = None, offset: int | None = None, top_rows: int = TOP_ROWS
) -> DataFrame:
    """Queue rows of these statuses by id, their distinct key. An offset without a limit reads the next 10,000 rows.

    Where more than `top_rows` rows would have to be sorted in one task, the ids at the offset and at the end are found
    by counts (see id_at), and rows between them are read and sorted by ranges.
    """
    rows = queue.where(F.col("processing_status").isin(statuses or fixed.QUEUE_STATUSES))
    start, n = offset or 0, limit or (fixed.OFFSET_ROWS if offset else None)
    if n is not None and start + n <= top_rows:
        rows = rows.orderBy("id").offset(start).limit(n)
    elif n is not None:
        first = id_at(rows, start, top_rows) if start else None
        if start and first is None:
            rows = rows.where("false")
        elif first is not None:
            rows = rows.where(F.col("id") >= first)
        end = id_at(rows, n, top_rows)
        rows = (rows if end is None else rows.where(F.col("id") < end)).orderBy("id")
    else:
        rows = rows.orderBy("id")
    return rows.select("id", "product_type_id", "product_page_url", "processing_status", "retry_count", "claimed_at", "claimed_by")


def first_of_each(new: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The first row of each key, without the columns of the order."""
    columns = [c for c in new.columns if c not in order]
    first = new.groupBy(key).agg(F.min_by(F.struct(*[c for c in columns if c != key]), F.struct(*order)).alias("__row"))
    return first.select(key, "__row.*").select(*columns)


def insert_if_absent(new: DataFrame, existing: DataFrame, key: str = "product_url", order: tuple[str, ...] = ("page_id", "pos")) -> DataFrame:
    """The rows to append: the first of each key by `order`, of those whose key isn't there yet.

    New rows are reduced to one a key before they meet the target: popular keys are many rows here and one there.
    """
    picked = first_of_each(new, key, order)
    return picked.join(existing.select(key), key, "left_anti").select(*picked.columns)


def write_queue(queue: DataFrame, updates: DataFrame) -> DataFrame:
    """The queue with the updates applied by id: null leaves a column as it is, the claim of an updated row is cleared.

    Of several updates of one id the last by retry_count counts.
    """
    last = Window.partitionBy("id").orderBy(F.desc("retry_count"), F.desc("processing_status"))
    one = updates.withColumn("__at", F.row_number().over(last)).where("__at = 1").drop("__at").withColumn("__hit", F.lit(True))
    one = one.select(F.col("id"), *[F.col(c).alias(f"__{c}") for c in updates.columns if c != "id"], "__hit")
    joined = queue.join(one, "id", "left")
    changed = [c for c in updates.columns if c != "id"]
    out = []
    for field in QUEUE.fields:
        c = F.col(field.name)
        if field.name in changed:
            c = F.coalesce(F.col(f"__{field.name}"), c)
        elif field.name in ("claimed_by", "claimed_at"):
            c = F.when(F.col("__hit"), F.lit(None)).otherwise(c)
        out.append(c.cast(field.dataType).alias(field.name))
    return joined.select(*out)
