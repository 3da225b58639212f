"""Schemas of the tables, see FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "ARRAY<BIGINT>": T.ArrayType(T.LongType()),
}


def _ddl(text: str) -> T.StructType:
    """As StructType.fromDDL(), which needs a running session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (f.split(" ") for f in text.split(", "))])


PAGES = _ddl("page_id BIGINT, url STRING, html STRING")

PRODUCT_FIELDS = (
    "title STRING, product_url STRING, image_url STRING, price DOUBLE, currency STRING, raw_price STRING, rating DOUBLE, "
    "review_count BIGINT, in_stock BOOLEAN, brand STRING, sku STRING, description STRING"
)
PRODUCT_NAMES = _ddl(PRODUCT_FIELDS).names
#: `pos` orders candidates of a page: an array of numbers, compared from the left.
CANDIDATES = _ddl(f"page_id BIGINT, rung INT, pos ARRAY<BIGINT>, {PRODUCT_FIELDS}")

PRODUCT_ROWS = _ddl(
    "platform_url STRING, product_name STRING, original_price STRING, current_price DOUBLE, product_url STRING, "
    "product_image_url STRING, description STRING, rating DOUBLE, reviews BIGINT, in_stock BOOLEAN, brand STRING, "
    "product_type_id BIGINT, searched_product_id BIGINT"
)

QUEUE = _ddl(
    "id BIGINT, product_type_id BIGINT, product_page_url STRING, processing_status STRING, retry_count INT, "
    "claimed_by STRING, claimed_at TIMESTAMP, success BOOLEAN, products_found BIGINT, products_saved BIGINT, "
    "error_message STRING, processed_at TIMESTAMP, updated_at TIMESTAMP"
)

JOB_FIELDS = (
    "url STRING, url_id BIGINT, max_items INT, wait_seconds INT, max_retries INT, retry_count INT, product_type_id BIGINT, searched_product_id BIGINT"
)
JOBS = _ddl(JOB_FIELDS)
PAYLOADS = _ddl("payload_id BIGINT, text STRING")
OUTCOMES = _ddl(
    "url_id BIGINT, kind STRING, success BOOLEAN, num_products BIGINT, saved_to_db BIGINT, error STRING, retry_count INT, max_retries INT"
)
