"""Product candidates: validity, merging by url, cap, cleansing, and rows for the product table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import clean_text, looks_like_phone_or_nav
from ..functions.urls import is_blacklisted_link, is_product_like_path
from ..schemas import PRODUCT_NAMES


def truthy(c: Column, kind: T.DataType) -> Column:
    """Neither null nor empty, zero or false."""
    if isinstance(kind, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(kind, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    return c.isNotNull() & (c != 0)


def is_valid_product() -> Column:
    """On the columns title, product_url, price and raw_price."""
    url, price, raw = F.col("product_url"), F.col("price"), F.col("raw_price")
    title = clean_text(F.col("title"))
    priced = truthy(price, T.DoubleType())
    has_title = title.isNotNull()
    valid = (
        ~is_blacklisted_link(url)
        & (is_product_like_path(url) | (priced & has_title))
        & ~F.coalesce(looks_like_phone_or_nav(title) | (F.length(title) < 2), F.lit(False))
        & (has_title | priced | truthy(raw, T.StringType()))
    )
    return F.coalesce(valid, F.lit(False))


def valid_products(candidates: DataFrame) -> DataFrame:
    return candidates.where(is_valid_product())


def first_per_page(rows: DataFrame, n: int) -> DataFrame:
    """The first `n` of each page by `pos`."""
    at = Window.partitionBy("page_id").orderBy("pos")
    return rows.withColumn("__at", F.row_number().over(at)).where(F.col("__at") <= n).drop("__at")


def merge_by_url(candidates: DataFrame) -> DataFrame:
    """One row for each (page_id, product_url): each field is its first truthy value by `pos`, else the first row's.

    Rows without url go; `pos` is that of the first row. Other columns are taken from the first row.
    """
    kinds = {f.name: f.dataType for f in candidates.schema.fields}
    merged = []
    for name in candidates.columns:
        if name in ("page_id", "product_url"):
            continue
        first = F.min_by(name, "pos")
        if name == "pos":
            first = F.min("pos")
        elif name in PRODUCT_NAMES:
            first = F.coalesce(F.min_by(name, F.when(truthy(F.col(name), kinds[name]), F.col("pos"))), first)
        merged.append(first.alias(name))
    out = candidates.where("product_url IS NOT NULL AND product_url <> ''").groupBy("page_id", "product_url").agg(*merged)
    return out.select(*candidates.columns)


def cap_per_page(products: DataFrame, n: int = fixed.MAX_ITEMS) -> DataFrame:
    return first_per_page(products, n)


def rounded(x: Column, digits: int = 2) -> Column:
    """The double nearest to x in decimals, as the exact binary value has it; ties go to the even digit.

    The product by a power of ten is taken with its error term (Dekker's split), as the product alone may round a value
    just off the middle to the middle.
    """
    scale = 10.0**digits
    big = x * 134217729.0
    high = big - (big - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    whole = F.floor(product).cast("double")
    part = product - whole
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 != 0))))
    return F.when(x == 0, x).otherwise((whole + F.when(up, 1.0).otherwise(0.0)) / scale)  # a zero keeps its sign


def sanitized_price(c: Column) -> Column:
    x = F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))  # of all orders, NaN is above every number here: it is no price
    return F.when(x < 0, F.lit(None)).when(x > fixed.MOST_PRICE, fixed.MOST_PRICE).otherwise(rounded(x))


def sanitized_rating(c: Column) -> Column:
    x = F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))
    return F.when(x < 0, 0.0).when(x > fixed.MOST_RATING, fixed.MOST_RATING).otherwise(rounded(x))


def sanitized_reviews(c: Column) -> Column:
    n = c.try_cast("double").try_cast("bigint")
    return F.when(n >= 0, n)


def sanitize_products(products: DataFrame) -> DataFrame:
    """Prices, ratings and reviews within their limits; what is no number, NaN included, is null."""
    return products.withColumns(
        {"price": sanitized_price(F.col("price")), "rating": sanitized_rating(F.col("rating")), "review_count": sanitized_reviews(F.col("review_count"))}
    )


def _complete() -> Column:
    return truthy(F.col("title"), T.StringType()) & truthy(F.col("product_url"), T.StringType())


def to_product_rows(products: DataFrame, *keys: str) -> DataFrame:
    """The 13 columns of the product table (`keys` in front), of rows with a name and a url.

    `products` also has platform_url, product_type_id and searched_product_id.
    """
    return products.where(_complete()).select(
        *keys,
        "platform_url",
        F.col("title").alias("product_name"),
        F.col("raw_price").alias("original_price"),
        F.col("price").alias("current_price"),
        "product_url",
        F.col("image_url").alias("product_image_url"),
        "description",
        "rating",
        F.col("review_count").alias("reviews"),
        "in_stock",
        "brand",
        "product_type_id",
        "searched_product_id",
    )


def save_counts(products: DataFrame) -> DataFrame:
    """(page_id, saved, failed): rows with name and url count as saved, whether their key is new or known."""
    return products.groupBy("page_id").agg(
        F.sum(F.when(_complete(), 1).otherwise(0)).cast("bigint").alias("saved"), F.sum(F.when(_complete(), 0).otherwise(1)).cast("bigint").alias("failed")
    )
