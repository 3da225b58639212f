"""The ladder: of each page, the candidates of the first strategy that finds a valid one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import page_says_no_results
from ..functions.urls import platform
from ..operators import strategies as s
from ..operators.nodes import node_rows, page_text, parse_nodes
from ..operators.products import cap_per_page, merge_by_url, sanitize_products, save_counts
from ..sources.staged import staged


def parsed_pages(pages: DataFrame) -> DataFrame:
    """parse_nodes() of pages, written once, as several strategies read it."""
    return staged(parse_nodes(pages), "parsed_pages")


def staged_nodes(parsed: DataFrame) -> DataFrame:
    """node_rows() of parsed pages, written once."""
    return staged(node_rows(parsed), "nodes")


def run_ladder(pages: DataFrame, max_items: int = fixed.MAX_ITEMS, parsed: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Candidates (page_id, rung, pos, product fields) of pages (page_id, url, html)."""
    parsed = parsed_pages(pages) if parsed is None else parsed
    urls = pages.select("page_id", "url")
    nodes = staged_nodes(parsed)
    found = (
        s.extract_dom(nodes, parsed, max_items)
        .unionByName(s.extract_jsonld(parsed, urls, max_items, strict))
        .unionByName(s.extract_microdata(nodes, parsed, max_items))
        .unionByName(s.extract_inline_json(parsed, urls, max_items, strict))
    )
    found = staged(found, "first_rungs")
    best = found.groupBy("page_id").agg(F.min("rung").alias("rung"))
    first = found.join(best, ["page_id", "rung"])
    # the last two look at every section, so only pages without anything so far get there
    nodes = staged(nodes.join(best, "page_id", "left_anti"), "late_nodes")
    late = s.extract_heuristic(nodes, parsed, max_items).unionByName(s.extract_linked_images(nodes, parsed, max_items))
    best = late.groupBy("page_id").agg(F.min("rung").alias("rung"))
    return first.unionByName(late.join(best, ["page_id", "rung"]), allowMissingColumns=False)


def products_of(candidates: DataFrame, max_items: int = fixed.MAX_ITEMS) -> DataFrame:
    return cap_per_page(merge_by_url(candidates), max_items)


def listing_products(pages: DataFrame, max_items: int = fixed.MAX_ITEMS) -> DataFrame:
    """Products of pages: ladder, merged by url, capped, cleansed."""
    return sanitize_products(products_of(run_ladder(pages, max_items), max_items))


def page_results(pages: DataFrame, products: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """(page_id, page_url, platform, success, num_products, saved_to_db) of every page.

    A page without products which says that there are none has nothing to save: null instead of 0.
    """
    parsed = parse_nodes(pages) if parsed is None else parsed
    said = parsed.select("page_id", page_says_no_results(page_text()).alias("none"))
    counts = products.groupBy("page_id").agg(F.count("*").alias("n")).join(save_counts(products), "page_id")
    rows = pages.select("page_id", "url").join(said, "page_id", "left").join(counts, "page_id", "left")
    n = F.coalesce("n", F.lit(0))
    return rows.select(
        "page_id",
        F.col("url").alias("page_url"),
        platform(F.col("url")).alias("platform"),
        F.lit(True).alias("success"),
        n.cast("bigint").alias("num_products"),
        F.when((n == 0) & F.coalesce("none", F.lit(False)), F.lit(None)).otherwise(F.coalesce("saved", F.lit(0))).cast("bigint").alias("saved_to_db"),
    )
