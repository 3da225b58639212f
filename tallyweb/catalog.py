"""The registered queries of the library, with the SQL that they are held against.

The driver's tables stand in for the library's own: `orders` for the work queue, `events` for outcomes, `lineitem` for
candidates and for price texts, `part` for listing pages (see FIXTURES.md).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed, text, urls
from .operators import jobs, products, selectors
from .operators import strategies as s
from .operators.nodes import node_rows, parse_nodes, with_text
from .plans import ladder, queue_run
from .schemas import PRODUCT_NAMES, PRODUCT_ROWS, QUEUE
from .sources import payloads, tables
from .sources.keyed_table import KeyedTable
from .sources.listing_pages import full_pages, part_pages
from .sources.queue_log import QueueLog
from .sources.staged import staged_dir
from .streaming.stream import product_table, stream_products

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
AT = datetime(2024, 1, 1)
AT_SQL = "TIMESTAMP '2024-01-01 00:00:00'"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _any(c: str, words: list[str]) -> str:
    """SQL: whether the text holds any of the words."""
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladder.listing_products(part_pages(table(spark, sf_dir, "part"))).drop("pos")


# --- Texts and prices ----------------------------------------------------------------------------------------------

PRICE_TEXTS = ["${}", "Rs. {}", "{} €", "now CAD ${} only", "GBP {}", "Call us", "", "₹ {}", "usd {}.", "{} dollars"]
_AMOUNT = "printf('%.2f', l_extendedprice)"
PRICE_TEXT_SQL = (
    "(SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_linenumber) % 10 "
    + " ".join(f"WHEN {i} THEN " + (f"replace('{t}', '{{}}', {_AMOUNT})" if "{}" in t else f"'{t}'") for i, t in enumerate(PRICE_TEXTS))
    + " END AS t FROM lineitem)"
)


def price_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.format_string("%.2f", "l_extendedprice").alias("amount"))
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % len(PRICE_TEXTS)
    made = F.coalesce(*[F.when(kind == i, F.replace(F.lit(t), F.lit("{}"), F.col("amount"))) for i, t in enumerate(PRICE_TEXTS)])
    return lines.select("l_orderkey", "l_linenumber", made.alias("t"))


@query("t1_clean_text", r"SELECT doc_id, sha256(coalesce(nullif(trim(regexp_replace(text, '[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')), ''), '')) AS cleaned FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(F.coalesce(text.clean_text(F.col("text")), F.lit("")), 256).alias("cleaned"))


@query("t2_parse_price", f"SELECT l_orderkey, l_linenumber, TRY_CAST(replace(regexp_extract(t, '[0-9,.]+'), ',', '') AS DOUBLE) AS price FROM {PRICE_TEXT_SQL}")
def _(spark, sf):
    return price_texts(spark, sf).select("l_orderkey", "l_linenumber", text.parse_price(F.col("t"))["price"].alias("price"))


_CURRENCY_SQL = "CASE " + " ".join(f"WHEN {_any('lower(t)', words)} THEN '{code}'" for code, words in fixed.CURRENCIES) + " END"


@query("t3_detect_currency", f"SELECT l_orderkey, l_linenumber, {_CURRENCY_SQL} AS currency FROM {PRICE_TEXT_SQL}")
def _(spark, sf):
    return price_texts(spark, sf).select("l_orderkey", "l_linenumber", text.detect_currency(F.col("t")).alias("currency"))


@query("t4_parse_int", "SELECT doc_id, TRY_CAST(regexp_extract(text, '[0-9]+') AS BIGINT) AS n FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.parse_int(F.col("text")).alias("n"))


@query("t5_parse_float", f"SELECT l_orderkey, l_linenumber, TRY_CAST(regexp_extract(t, '[0-9.]+') AS DOUBLE) AS x FROM {PRICE_TEXT_SQL}")
def _(spark, sf):
    return price_texts(spark, sf).select("l_orderkey", "l_linenumber", text.parse_float(F.col("t")).alias("x"))


_STOCK = "CASE l_linestatus WHEN 'O' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'In Stock' ELSE 'unavailable' END ELSE CASE WHEN l_linenumber % 3 = 0 THEN 'OutOfStock' WHEN l_linenumber % 3 = 1 THEN 'Preorder' END END"


@query(
    "t6_infer_in_stock",
    f"SELECT l_orderkey, l_linenumber, CASE WHEN {_any('lower(s)', fixed.IN_STOCK)} THEN true WHEN {_any('lower(s)', fixed.OUT_OF_STOCK)} THEN false END AS in_stock FROM (SELECT *, {_STOCK} AS s FROM lineitem)",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.infer_in_stock(F.expr(_STOCK)).alias("in_stock"))


@query("t7_truncate", "SELECT doc_id, substr(text, 1, 400) AS short FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.truncate(F.col("text"), fixed.DESCRIPTION_CHARS).alias("short"))


@query(
    "u3_extract_price_text",
    rf"SELECT l_orderkey, l_linenumber, nullif(regexp_extract(t, '(?i)(rs\.?|(inr|usd|eur|cad|aud)\s|₹|£|€|\$)\s*[0-9,.]+'), '') AS raw_price FROM {PRICE_TEXT_SQL}",
)
def _(spark, sf):
    return price_texts(spark, sf).select("l_orderkey", "l_linenumber", text.extract_price_text(F.col("t")).alias("raw_price"))


@query("u7_phone_or_nav", rf"SELECT doc_id, coalesce(regexp_matches(lower(text), '\b[0-9]{{8,}}\b') OR {_any('lower(text)', fixed.NAV_WORDS)}, false) AS refused FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.looks_like_phone_or_nav(F.col("text")).alias("refused"))


@query("h9_page_no_results", f"SELECT doc_id, coalesce({_any('lower(text)', fixed.NO_RESULTS_PHRASES)}, false) AS none FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.page_says_no_results(F.col("text")).alias("none"))


# --- Urls and pages ------------------------------------------------------------------------------------------------


@query("s1_read_pages", "SELECT page_id, url, length(html) AS chars FROM pages")
def _(spark, sf):
    return tables.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


@query("u1_to_absolute", r"SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/p/' || page_id || '?x=1' AS absolute FROM pages")
def _(spark, sf):
    href = F.concat(F.lit("/p/"), F.col("page_id").cast("string"), F.lit("?x=1"))
    return table(spark, sf, "pages").select("page_id", urls.to_absolute(F.col("url"), href).alias("absolute"))


@query("u2_platform", r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS platform FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.platform(F.col("url")).alias("platform"))


_REFUSED_SQL = f"(url IS NULL OR url = '' OR regexp_matches(lower(url), '^({'|'.join(fixed.LINK_SCHEMES_REFUSED)})') OR {_any('lower(url)', fixed.LINK_KEYWORDS_REFUSED)})"
_PATH_SQL = r"regexp_replace(lower(url), '^[a-z]+://[^/?#]*|[?#].*$', '', 'g')"
_AFTER_SQL = r"regexp_extract(lower(url), '^[a-z]+://[^/?#]*(.*)$', 1)"
_LIKE_SQL = f"""CASE WHEN {_PATH_SQL} IN {_in(fixed.HOME_PATHS)} THEN false WHEN {_any(_AFTER_SQL, fixed.PRODUCT_KEYWORDS)} THEN true
  WHEN {_any(_AFTER_SQL, fixed.PATH_KEYWORDS_REFUSED)} THEN false
  ELSE regexp_matches({_PATH_SQL}, '\\.html?$') OR (length({_PATH_SQL}) - length(replace({_PATH_SQL}, '/', '')) >= 2 AND length({_PATH_SQL}) > 3)
    OR (contains({_PATH_SQL}, '-') AND length(replace({_PATH_SQL}, '-', '')) > 6) END"""


@query("u4_blacklisted_link", f"SELECT page_id, {_REFUSED_SQL} AS refused FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.is_blacklisted_link(F.col("url")).alias("refused"))


@query("u5_product_like_path", f"SELECT page_id, {_LIKE_SQL} AS product_like FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.is_product_like_path(F.col("url")).alias("product_like"))


@query("u6_potential_product", f"SELECT page_id, NOT {_REFUSED_SQL} AND {_LIKE_SQL} AS potential FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.is_potential_product_href(F.col("url")).alias("potential"))


@query("h6_blacklisted_section", "SELECT page_id, len(regexp_extract_all(html, '<a '))::BIGINT AS anchors, len(regexp_extract_all(html, '<a '))::BIGINT AS refused FROM pages WHERE len(regexp_extract_all(html, '<a ')) > 0")
def _(spark, sf):
    anchors = node_rows(parse_nodes(table(spark, sf, "pages")), lambda n: n["tag"] == "a")
    return anchors.groupBy("page_id").agg(F.count("*").alias("anchors"), F.count_if("blacklisted").alias("refused"))


@query("h8_page_anchors", "SELECT page_id, '' AS href FROM pages WHERE false")
def _(spark, sf):
    return selectors.page_anchors(node_rows(parse_nodes(table(spark, sf, "pages")))).select("page_id", selectors.attr("href").alias("href"))


# --- Candidates and products ---------------------------------------------------------------------------------------

_CANDIDATE_SQL = """(
  SELECT l_suppkey AS page_id, l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    CASE l_partkey % 6 WHEN 0 THEN NULL ELSE 'https://shop.example.com/' || CASE l_partkey % 6 WHEN 1 THEN 'cart/' WHEN 2 THEN 'x' WHEN 3 THEN '' ELSE 'product/' END || (l_partkey % 100) END AS product_url,
    CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'T' WHEN 2 THEN 'Home lamp ' || l_orderkey ELSE 'Lamp ' || l_orderkey END AS title,
    CASE WHEN l_quantity >= 25 THEN l_extendedprice WHEN l_quantity >= 10 THEN 0.0 END AS price,
    CASE WHEN l_linenumber % 2 = 0 THEN printf('%.2f', l_extendedprice) END AS raw_price,
    CASE WHEN l_discount >= 0.05 THEN l_discount * 100 END AS rating,
    CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'R' THEN l_orderkey END AS review_count,
    CASE WHEN l_returnflag = 'N' THEN false WHEN l_returnflag = 'A' THEN true END AS in_stock,
    CASE WHEN l_linestatus = 'O' THEN 'Brand ' || l_partkey END AS brand
  FROM lineitem)"""


def line_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda n: F.col("l_partkey") % n
    folder = F.when(key(6) == 1, "cart/").when(key(6) == 2, "x").when(key(6) == 3, "").otherwise("product/")
    url = F.when(key(6) != 0, F.concat(F.lit("https://shop.example.com/"), folder, key(100).cast("string")))
    line, order = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    title = F.when(line % 4 == 1, "T").when(line % 4 == 2, F.concat(F.lit("Home lamp "), order)).when(line % 4 == 3, F.concat(F.lit("Lamp "), order))
    flag, none = F.col("l_returnflag"), F.lit(None).cast("string")
    values = {
        "title": title,
        "product_url": url,
        "image_url": none,
        "price": F.when(F.col("l_quantity") >= 25, F.col("l_extendedprice")).when(F.col("l_quantity") >= 10, 0.0),
        "currency": none,
        "raw_price": F.when(line % 2 == 0, F.format_string("%.2f", "l_extendedprice")),
        "rating": F.when(F.col("l_discount") >= 0.05, F.col("l_discount") * 100),
        "review_count": F.when(flag == "A", 0).when(flag == "R", F.col("l_orderkey")).cast("bigint"),
        "in_stock": F.when(flag == "N", False).when(flag == "A", True),
        "brand": F.when(F.col("l_linestatus") == "O", F.concat(F.lit("Brand "), F.col("l_partkey").cast("string"))),
        "sku": none,
        "description": none,
    }
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_suppkey").alias("page_id"), F.lit(1).alias("rung"), F.array(F.col("l_orderkey"), line.cast("bigint"), F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("pos"), *[values[n].alias(n) for n in PRODUCT_NAMES]
    )


_SHOWN = ["title", "price", "raw_price", "rating", "review_count", "in_stock", "brand"]
_PLACE = "pos[0] AS l_orderkey", "pos[1] AS l_linenumber"


@query(
    "v1_valid_products",
    f"""SELECT page_id, l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM (SELECT *, product_url AS url FROM {_CANDIDATE_SQL})
    WHERE NOT {_REFUSED_SQL} AND ({_LIKE_SQL} OR (coalesce(price, 0) <> 0 AND title IS NOT NULL))
      AND NOT coalesce(regexp_matches(lower(title), '\\b[0-9]{{8,}}\\b') OR {_any('lower(title)', fixed.NAV_WORDS)} OR length(title) < 2, false)
      AND (title IS NOT NULL OR coalesce(price, 0) <> 0 OR coalesce(raw_price, '') <> '')""",
)
def _(spark, sf):
    return products.valid_products(line_candidates(spark, sf)).selectExpr("page_id", *_PLACE)


def _first_sql(c: str, truth: str) -> str:
    of = lambda where: f"(list({c} ORDER BY l_orderkey, l_linenumber, cents){where})[1]"
    return f"coalesce({of(f' FILTER ({truth})')}, {of('')}) AS {c}"


_MERGED_SQL = f"""(SELECT page_id, product_url, min((l_orderkey * 10 + l_linenumber) * 100000000 + cents) AS place, {_first_sql('title', "title <> ''")}, {_first_sql('price', 'price <> 0')},
  {_first_sql('raw_price', "raw_price <> ''")}, {_first_sql('rating', 'rating <> 0')}, {_first_sql('review_count', 'review_count <> 0')},
  {_first_sql('in_stock', 'in_stock')}, {_first_sql('brand', "brand <> ''")}
  FROM {_CANDIDATE_SQL} WHERE product_url IS NOT NULL GROUP BY page_id, product_url)"""


@query("a1_merge_by_url", f"SELECT page_id, product_url, {', '.join(_SHOWN)} FROM {_MERGED_SQL}")
def _(spark, sf):
    return products.merge_by_url(line_candidates(spark, sf)).select("page_id", "product_url", *_SHOWN)


@query("a2_cap_per_page", f"SELECT page_id, product_url, title FROM {_MERGED_SQL} QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY place) <= 50")
def _(spark, sf):
    return products.cap_per_page(products.merge_by_url(line_candidates(spark, sf))).select("page_id", "product_url", "title")


@query(
    "a3_sanitize_products",
    f"""SELECT page_id, l_orderkey, l_linenumber::BIGINT AS l_linenumber,
      CASE WHEN price < 0 THEN NULL WHEN price > 999999999.99 THEN 999999999.99 ELSE round(price, 2) END AS price,
      CASE WHEN rating < 0 THEN 0.0 WHEN rating > 100 THEN 100.0 ELSE round(rating, 2) END AS rating,
      CASE WHEN review_count >= 0 THEN review_count END AS review_count
    FROM (SELECT page_id, l_orderkey, l_linenumber, price * (l_linenumber - 2) * 5000 AS price, rating * 30 - 200 AS rating, review_count - 1000 AS review_count FROM {_CANDIDATE_SQL})""",
)
def _(spark, sf):
    rows = line_candidates(spark, sf)
    line = F.col("pos")[1]
    rows = rows.withColumns({"price": F.col("price") * (line - 2) * 5000, "rating": F.col("rating") * 30 - 200, "review_count": F.col("review_count") - 1000})
    return products.sanitize_products(rows).selectExpr("page_id", *_PLACE, "price", "rating", "review_count")


@query(
    "a3_not_a_number",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_orderkey % 3 > 0 THEN l_extendedprice END AS price,
      CASE WHEN l_orderkey % 2 > 0 THEN l_quantity END AS rating, CASE WHEN l_orderkey % 5 > 0 THEN l_quantity::BIGINT END AS review_count FROM lineitem""",
)
def _(spark, sf):
    key, nan = F.col("l_orderkey"), F.lit(float("nan"))
    of = lambda n, c: F.when(key % n > 0, F.col(c).cast("double")).otherwise(nan)
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), of(3, "l_extendedprice").alias("price"), of(2, "l_quantity").alias("rating"), of(5, "l_quantity").alias("review_count")
    )
    return products.sanitize_products(rows)


def _owned(rows: DataFrame) -> DataFrame:
    """With what a product row takes from its page and job."""
    page = F.col("page_id")
    return rows.withColumns(
        {"platform_url": F.concat(F.lit("https://shop.example.com/list/"), page.cast("string")), "product_type_id": page % 7, "searched_product_id": F.lit(None).cast("bigint")}
    )


_ROW_SQL = """'https://shop.example.com/list/' || page_id AS platform_url, title AS product_name, raw_price AS original_price, price AS current_price, product_url,
  NULL::VARCHAR AS product_image_url, NULL::VARCHAR AS description, rating, review_count AS reviews, in_stock, brand, page_id % 7 AS product_type_id, NULL::BIGINT AS searched_product_id"""


@query("a4_to_product_rows", f"SELECT {_ROW_SQL} FROM {_CANDIDATE_SQL} WHERE title <> '' AND product_url <> ''")
def _(spark, sf):
    return products.to_product_rows(_owned(line_candidates(spark, sf)))


@query(
    "a5_save_counts",
    f"SELECT page_id, count(*) FILTER (title <> '' AND product_url <> '') AS saved, count(*) FILTER (NOT coalesce(title <> '' AND product_url <> '', false)) AS failed FROM {_CANDIDATE_SQL} GROUP BY page_id",
)
def _(spark, sf):
    return products.save_counts(line_candidates(spark, sf))


@query(
    "s5_insert_if_absent",
    f"""SELECT platform_url, product_name, product_url FROM (SELECT {_ROW_SQL}, page_id, l_orderkey, l_linenumber, cents FROM {_CANDIDATE_SQL} WHERE title <> '' AND product_url <> '')
    WHERE product_url NOT IN (SELECT 'https://shop.example.com/product/' || p_partkey FROM part WHERE p_partkey % 3 = 0)
    QUALIFY row_number() OVER (PARTITION BY product_url ORDER BY page_id, l_orderkey, l_linenumber, cents) = 1""",
)
def _(spark, sf):
    new = products.to_product_rows(_owned(line_candidates(spark, sf)), "page_id", "pos")
    known = table(spark, sf, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("https://shop.example.com/product/"), F.col("p_partkey").cast("string")).alias("product_url"))
    return tables.insert_if_absent(new, known).select("platform_url", "product_name", "product_url")


_LINE_ROWS_SQL = f"(SELECT {_ROW_SQL}, page_id, l_orderkey, l_linenumber, cents FROM {_CANDIDATE_SQL} WHERE title <> '' AND product_url <> '')"


@query(
    "s5_keyed_load",
    f"""SELECT platform_url, product_name, product_url FROM {_LINE_ROWS_SQL}
    QUALIFY row_number() OVER (PARTITION BY product_url ORDER BY page_id % 2, page_id, l_orderkey, l_linenumber, cents) = 1""",
)
def _(spark, sf):
    """Loads of the lines of even pages, of these again, and of odd pages, into one keyed table."""
    target = KeyedTable(spark, f"{staged_dir(spark)}/s5-{uuid.uuid4().hex}", PRODUCT_ROWS, "product_url", parts=16)
    rows = products.to_product_rows(_owned(line_candidates(spark, sf)), "page_id", "pos")
    for some in (rows.where("page_id % 2 = 0"), rows.where("page_id % 2 = 0"), rows.where("page_id % 2 = 1")):
        target.insert(some, order=("page_id", "pos"))
    return target.rows().select("platform_url", "product_name", "product_url")


# --- Strategies, on pages made of parts ----------------------------------------------------------------------------

_PART = "(SELECT *, p_partkey // 20 AS page_id, (p_partkey // 20) % 6 AS kind, '/product/' || p_partkey AS path, 'https://shop.example.com' AS base, printf('%.2f', p_retailprice) AS t FROM part)"
#: What each template of listing_pages.py shows of a part
_SHOWS_SQL = f"""(SELECT page_id, kind + 1 AS rung, p_name AS title, base || path AS product_url,
  CASE WHEN kind <> 3 THEN base || '/img/' || p_partkey || '.png' END AS image_url,
  CASE WHEN kind <> 5 THEN p_retailprice END AS price,
  CASE kind WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CAD' WHEN 4 THEN 'USD' END AS currency,
  CASE WHEN kind IN (0, 4) THEN '$' || t WHEN kind <> 5 THEN t END AS raw_price,
  CASE WHEN kind IN (0, 1) THEN true END AS in_stock, CASE WHEN kind <= 2 THEN p_brand END AS brand,
  CASE WHEN kind IN (1, 3) THEN 'S-' || p_partkey END AS sku FROM {_PART})"""
_SHOWN_OF_PART = ["page_id", "title", "product_url", "image_url", "price", "currency", "raw_price", "in_stock", "brand", "sku"]


def _strategy(rung: int) -> Query:
    by_nodes = {1: s.extract_dom, 3: s.extract_microdata, 5: s.extract_heuristic, 6: s.extract_linked_images}
    by_scripts = {2: s.extract_jsonld, 4: s.extract_inline_json}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = part_pages(table(spark, sf_dir, "part"))
        parsed, of = ladder.parsed_pages(pages), pages.select("page_id", "url")
        rows = by_nodes[rung](ladder.staged_nodes(parsed), parsed) if rung in by_nodes else by_scripts[rung](parsed, of)
        return products.merge_by_url(rows).select(*_SHOWN_OF_PART)

    return run


for _rung, _name in enumerate(["dom", "jsonld", "microdata", "inline_json", "heuristic", "linked_images"], 1):
    # linked images show on cards of the first template as well, as titles, links and images only
    _also = f" UNION ALL SELECT page_id, title, product_url, image_url, {', '.join('NULL AS ' + c for c in _SHOWN_OF_PART[4:])} FROM {_SHOWS_SQL} WHERE rung = 1" if _rung == 6 else ""
    query(f"e{_rung}_extract_{_name}", f"SELECT {', '.join(_SHOWN_OF_PART)} FROM {_SHOWS_SQL} WHERE rung = {_rung}{_also}")(_strategy(_rung))


@query("e11_run_ladder", f"SELECT rung::INTEGER AS rung, {', '.join(_SHOWN_OF_PART)} FROM {_SHOWS_SQL}")
def _(spark, sf):
    return ladder.products_of(ladder.run_ladder(part_pages(table(spark, sf, "part")))).select("rung", *_SHOWN_OF_PART)


@query(
    "e12_page_results",
    r"""SELECT page_id, url AS page_url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS platform, true AS success, 0::BIGINT AS num_products,
    0::BIGINT AS saved_to_db FROM pages""",
)
def _(spark, sf):
    pages = tables.read_pages(spark, f"{sf}/pages.parquet")
    parsed = ladder.parsed_pages(pages)
    return ladder.page_results(pages, ladder.products_of(ladder.run_ladder(pages, parsed=parsed)), parsed)


#: What pages of FULL show of a part
_FULL_SQL = """(SELECT p_partkey // 20 AS page_id, p_name AS title, 'https://shop.example.com/product/' || p_partkey AS product_url, 'https://shop.example.com/img/' || p_partkey || '.png' AS image_url,
  p_retailprice AS price, printf('%.2f', p_retailprice) AS raw_price, CAST((p_partkey % 5) || '.' || (p_partkey % 9) AS DOUBLE) AS rating, p_partkey * 7 AS review_count,
  false AS in_stock, p_brand AS brand, 'S-' || p_partkey AS sku, p_name || ', described at some length' AS description FROM part)"""
_FULL_FIELDS = ["page_id", *PRODUCT_NAMES]


def _full_sql(currency: str, before: str = "") -> str:
    of = {"currency": f"'{currency}' AS currency", "raw_price": f"'{before}' || raw_price AS raw_price"}
    return f"SELECT {', '.join(of.get(c, c) for c in _FULL_FIELDS)} FROM {_FULL_SQL}"


def _full(spark: SparkSession, sf_dir: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Parsed pages, and their addresses."""
    pages = full_pages(table(spark, sf_dir, "part"), kind)
    return ladder.parsed_pages(pages), pages.select("page_id", "url")


@query("e7_card_fields", _full_sql("USD", "$"))
def _(spark, sf):
    parsed, _ = _full(spark, sf, "cards")
    nodes = node_rows(parsed)
    return s.card_fields(nodes.where("tag = 'li'").select("page_id", "node_id", "subtree_end", "piece_start", "piece_count"), nodes, parsed).select(*_FULL_FIELDS)


@query("e8_ld_fields", _full_sql("EUR"))
def _(spark, sf):
    return s.extract_jsonld(*_full(spark, sf, "ld")).select(*_FULL_FIELDS)


@query("e9_generic_fields", _full_sql("CAD"))
def _(spark, sf):
    return s.extract_inline_json(*_full(spark, sf, "generic")).select(*_FULL_FIELDS)


@query("e10_blobs", f"SELECT page_id, title, product_url FROM {_FULL_SQL}")
def _(spark, sf):
    return s.extract_inline_json(*_full(spark, sf, "blobs")).select("page_id", "title", "product_url")


@query(
    "e10_deep_json",
    """SELECT p_partkey AS page_id, p_name AS title, 'https://shop.example.com/product/' || p_partkey AS product_url, (CASE WHEN p_partkey % 4 < 2 THEN 2 ELSE 4 END)::INTEGER AS rung
    FROM part WHERE p_partkey % 4 < 3""",
)
def _(spark, sf):
    """A page a part: its JSON-LD within 3,000 lists; the same, not well-formed after the part; inline JSON beside 2,000 open
    brackets; or brackets alone."""
    key = F.col("p_partkey")
    part = F.format_string('{"@type": "Product", "name": "%s", "url": "/product/%s"}', F.col("p_name"), key.cast("string"))
    ld = lambda text: F.concat(F.lit('<script type="application/ld+json">'), text, F.lit("</script>"))
    plain = lambda text: F.concat(F.lit('<script type="application/json">'), text, F.lit("</script>"))
    many = lambda x: F.repeat(F.lit(x), F.lit(3000))
    html = (
        F.when(key % 4 == 0, ld(F.concat(many("["), part, many("]"))))
        .when(key % 4 == 1, ld(F.concat(part, many("[{"))))
        .when(key % 4 == 2, plain(F.concat(part, many("{"))))
        .otherwise(F.concat(ld(many("{")), plain(many("["))))
    )
    pages = table(spark, sf, "part").select(key.alias("page_id"), F.concat(F.lit("https://shop.example.com/list/"), key.cast("string")).alias("url"), html.alias("html"))
    parsed, of = ladder.parsed_pages(pages), pages.select("page_id", "url")
    found = s.extract_jsonld(parsed, of).unionByName(s.extract_inline_json(parsed, of))
    return found.select("page_id", "title", "product_url", "rung")


@query(
    "e12_no_results",
    f"""SELECT page_id, 'shop.example.com' AS platform, true AS success, count(*) AS num_products, count(*) AS saved_to_db FROM {_SHOWS_SQL} GROUP BY page_id
    UNION ALL SELECT -1 - c_custkey, 'shop.example.com', true, 0, CASE WHEN c_custkey % 2 = 1 THEN 0 END FROM customer""",
)
def _(spark, sf):
    """Listing pages, and pages without products, half of which say that there are none."""
    key = F.col("c_custkey")
    says = F.when(key % 2 == 0, "<p>Sorry, No Results Found for this").otherwise("<p>Welcome")
    empty = table(spark, sf, "customer").select((-1 - key).cast("bigint").alias("page_id"), F.concat(F.lit("https://shop.example.com/none/"), key.cast("string")).alias("url"), says.alias("html"))
    pages = part_pages(table(spark, sf, "part")).unionByName(empty)
    parsed = ladder.parsed_pages(pages)
    return ladder.page_results(pages, ladder.products_of(ladder.run_ladder(pages, parsed=parsed)), parsed).drop("page_url")


# --- Elements and selectors, on pages made of parts ----------------------------------------------------------------

_PAGES_SQL = f"(SELECT page_id, kind, count(*) AS n FROM {_PART} GROUP BY page_id, kind)"


def _part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_rows(parse_nodes(part_pages(table(spark, sf_dir, "part"))))


@query(
    "h1_parse_nodes",
    f"""SELECT page_id, CASE kind WHEN 0 THEN 5 + 6 * n WHEN 1 THEN 5 WHEN 2 THEN 2 + 7 * n WHEN 3 THEN 4 WHEN 4 THEN 5 + 3 * n ELSE 4 + 2 * n END AS elements,
    CASE kind WHEN 0 THEN 5 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 4 WHEN 4 THEN 7 ELSE 6 END AS depth, (kind IN (1, 3))::BIGINT AS scripts FROM {_PAGES_SQL}""",
)
def _(spark, sf):
    deepest = F.array_max(F.transform("nodes", lambda n: n["depth"]))
    parsed = parse_nodes(part_pages(table(spark, sf, "part")))
    return parsed.select("page_id", F.size("nodes").cast("bigint").alias("elements"), deepest.alias("depth"), F.size("scripts").cast("bigint").alias("scripts"))


@query("h2_is_displayed", "SELECT p_partkey // 20 AS page_id, 2 + 2 * count(*) AS elements, 2 + 2 * count(*) FILTER (p_partkey % 3 = 2) AS displayed FROM part GROUP BY 1")
def _(spark, sf):
    nodes = node_rows(parse_nodes(full_pages(table(spark, sf, "part"), "hidden")))
    return nodes.groupBy("page_id").agg(F.count("*").alias("elements"), F.count_if("displayed").alias("displayed"))


@query("h3_element_text", f"SELECT page_id, CASE kind WHEN 0 THEN p_name || '$' || t || p_brand || 'In stock' ELSE '$' || t END AS said FROM {_PART} WHERE kind IN (0, 4)")
def _(spark, sf):
    parsed = ladder.parsed_pages(part_pages(table(spark, sf, "part")))
    return with_text(node_rows(parsed).where("tag = 'li'"), parsed).select("page_id", selectors.element_text(F.col("text")).alias("said"))


@query("h4_matches", f"SELECT page_id, CASE kind WHEN 0 THEN 4 WHEN 4 THEN 1 ELSE 2 END * n AS matching FROM {_PAGES_SQL} WHERE kind IN (0, 2, 4, 5)")
def _(spark, sf):
    fits = selectors.matches('li.product, a[title], span[class="price"], img[src*="/IMG/" i], [itemprop="NAME" i]')
    return _part_nodes(spark, sf).where(fits).groupBy("page_id").agg(F.count("*").alias("matching"))


@query(
    "h5_first_nonempty_selector",
    f"SELECT page_id, (CASE kind WHEN 0 THEN 1 WHEN 2 THEN 3 WHEN 4 THEN 2 ELSE 4 END)::INTEGER AS rank, CASE kind WHEN 5 THEN 2 ELSE n END AS matching FROM {_PAGES_SQL} WHERE kind IN (0, 2, 4, 5)",
)
def _(spark, sf):
    found = selectors.first_nonempty_selector(_part_nodes(spark, sf), ["ol", "li.product", "li", '[itemprop="name"]', "main, section"])
    return found.groupBy("page_id", "rank").agg(F.count("*").alias("matching"))


@query("h6_part_sections", f"SELECT page_id, n + (kind = 0)::BIGINT AS anchors, (kind = 0)::BIGINT AS refused FROM {_PAGES_SQL} WHERE kind IN (0, 4, 5)")
def _(spark, sf):
    anchors = _part_nodes(spark, sf).where("tag = 'a'")
    return anchors.groupBy("page_id").agg(F.count("*").alias("anchors"), F.count_if("blacklisted").alias("refused"))


@query("h7_looks_like_card", f"SELECT page_id, n AS cards FROM {_PAGES_SQL} WHERE kind IN (0, 4)")
def _(spark, sf):
    parsed = ladder.parsed_pages(part_pages(table(spark, sf, "part")))
    nodes = node_rows(parsed)
    return selectors.looks_like_card(nodes, nodes.where("tag IN ('li', 'div', 'article')"), parsed).groupBy("page_id").agg(F.count("*").alias("cards"))


@query("h8_part_anchors", f"SELECT page_id, path AS href FROM {_PART} WHERE kind IN (0, 4, 5)")
def _(spark, sf):
    return selectors.page_anchors(_part_nodes(spark, sf)).select("page_id", selectors.attr("href").alias("href"))


@query(
    "u1_relative_references",
    r"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'https://a.com/x/' || o_orderkey WHEN 1 THEN 'https://a.com/' || o_orderkey WHEN 2 THEN 'https://a.com/x/y?page=' || o_orderkey
      WHEN 3 THEN 'https://cdn.b.com/' || o_orderkey WHEN 4 THEN 'https://a.com/x/y?q=1#' || o_orderkey ELSE 'javascript:void(' || o_orderkey || ')' END AS absolute FROM orders""",
)
def _(spark, sf):
    key, number = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    before = F.get(F.array(*[F.lit(x) for x in ("", "../", "?page=", "//cdn.b.com/", "#", "javascript:void(")]), (key % 6).cast("int"))
    href = F.concat(before, number, F.when(key % 6 == 5, ")").otherwise(""))
    return table(spark, sf, "orders").select("o_orderkey", urls.to_absolute(F.lit("https://a.com/x/y?q=1"), href).alias("absolute"))


# --- Payloads ------------------------------------------------------------------------------------------------------

_PAYLOAD_SQL = """(
  SELECT o_orderkey AS payload_id, 0 AS pos, 'https://a.com/' || o_orderkey AS url, NULL::INTEGER AS max_items, NULL::BIGINT AS url_id FROM orders WHERE o_orderkey % 5 < 4
  UNION ALL SELECT o_orderkey, 1, 'https://b.com/' || o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 5 END, CASE o_orderkey % 5 WHEN 3 THEN o_orderkey END FROM orders WHERE o_orderkey % 5 IN (0, 2, 3))"""


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list, an object, commas, lines, or nothing."""
    key, k = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    a, b = F.concat(F.lit("https://a.com/"), k), F.concat(F.lit("https://b.com/"), k)
    texts = [
        F.format_string('["%s", {"url": "%s", "max_items": 5}, 7]', a, b),
        F.format_string('{"urls": ["%s"]}', a),
        F.format_string(" %s, %s ", a, b),
        F.format_string('# a comment\n\n%s\n{"url": "%s", "url_id": %s}\n', a, b, k),
        F.lit(" \n "),
    ]
    return table(spark, sf_dir, "orders").select(key.alias("payload_id"), F.coalesce(*[F.when(key % 5 == i, t) for i, t in enumerate(texts)]).alias("text"))


@query("s3_parse_url_payload", f"SELECT payload_id, pos, url, max_items, url_id FROM {_PAYLOAD_SQL}")
def _(spark, sf):
    return payloads.parse_url_payload(order_payloads(spark, sf)).select("payload_id", "pos", "url", "max_items", "url_id")


@query("s4_load_manual_urls", f"SELECT (payload_id % 2)::INTEGER AS source, payload_id, pos, url FROM {_PAYLOAD_SQL}")
def _(spark, sf):
    """Even orders' payloads are given inline, the others stand in files."""
    given = order_payloads(spark, sf)
    return payloads.load_manual_urls(given.where("payload_id % 2 = 0"), given.where("payload_id % 2 = 1")).select("source", "payload_id", "pos", "url")


_LOADED_SQL = f"SELECT 'https://shop.example.com/list/' || page_id AS platform_url, title AS product_name, price AS current_price, product_url FROM {_SHOWS_SQL}"


@query("r1_stream_products", _LOADED_SQL)
def _(spark, sf):
    """A stream of two batches loads the table: all pages, and half of them delivered again, which adds nothing."""
    folder = f"{staged_dir(spark)}/r1-{uuid.uuid4().hex}"
    pages = part_pages(table(spark, sf, "part"))
    for some in (pages, pages.where("page_id % 2 = 0")):
        some.coalesce(1).write.mode("append").parquet(f"{folder}/pages")
    stream_products(spark, f"{folder}/pages", f"{folder}/products", f"{folder}/checkpoint", max_files=1).awaitTermination()
    return product_table(spark, f"{folder}/products").rows().select("platform_url", "product_name", "current_price", "product_url")


# --- The queue -----------------------------------------------------------------------------------------------------

_QUEUE_SQL = """(SELECT o_orderkey AS id, o_custkey % 9 AS product_type_id, 'https://shop.example.com/list/' || o_orderkey AS product_page_url,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'retrying' END AS processing_status, (o_custkey % 5)::INTEGER AS retry_count,
  CASE WHEN o_custkey % 11 = 0 THEN 'other' END AS claimed_by FROM orders)"""


def order_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    values = {
        "id": key,
        "product_type_id": F.col("o_custkey") % 9,
        "product_page_url": F.concat(F.lit("https://shop.example.com/list/"), key.cast("string")),
        "processing_status": F.when(status == "F", "completed").when(status == "O", "pending").otherwise("retrying"),
        "retry_count": F.col("o_custkey") % 5,
        "claimed_by": F.when(F.col("o_custkey") % 11 == 0, "other"),
    }
    return table(spark, sf_dir, "orders").select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in QUEUE.fields])


_OPEN = "processing_status IN ('pending', 'retrying')"


@query("s2_load_queue", f"SELECT id, product_type_id, product_page_url, processing_status, retry_count, claimed_by FROM {_QUEUE_SQL} WHERE {_OPEN} ORDER BY id LIMIT 500 OFFSET 100")
def _(spark, sf):
    return tables.load_queue(order_queue(spark, sf), limit=500, offset=100).drop("claimed_at")


@query("s2_deep_offset", f"SELECT id, product_page_url, processing_status FROM {_QUEUE_SQL} WHERE {_OPEN} ORDER BY id LIMIT 300 OFFSET 400")
def _(spark, sf):
    """As s2, where no task may sort more than 50 rows."""
    return tables.load_queue(order_queue(spark, sf), limit=300, offset=400, top_rows=50).select("id", "product_page_url", "processing_status")


@query(
    "q1_parse_status_filters",
    f"SELECT id, processing_status, filters FROM {_QUEUE_SQL} JOIN (VALUES ('given', 'completed'), ('given', 'retrying'), ('none', 'pending'), ('none', 'retrying')) f(filters, status) ON processing_status = status",
)
def _(spark, sf):
    queue = order_queue(spark, sf)
    of = lambda name, text: queue.where(F.col("processing_status").isin(jobs.parse_status_filters(text))).select("id", "processing_status", F.lit(name).alias("filters"))
    return of("given", " Completed ,, RETRYING").unionByName(of("none", " , "))


@query("q2_start_id", f"SELECT id FROM {_QUEUE_SQL} WHERE {_OPEN} ORDER BY id LIMIT 1 OFFSET 250")
def _(spark, sf):
    return jobs.start_id(order_queue(spark, sf), fixed.QUEUE_STATUSES, 250)


@query("q2_deep_start", f"SELECT id FROM {_QUEUE_SQL} WHERE {_OPEN} ORDER BY id LIMIT 1 OFFSET 600")
def _(spark, sf):
    return jobs.start_id(order_queue(spark, sf), fixed.QUEUE_STATUSES, 600, top_rows=50)


@query("q3_large_claim", f"SELECT id, 'w-0' AS claimed_by FROM {_QUEUE_SQL} WHERE {_OPEN} AND claimed_by IS NULL AND id >= 50 ORDER BY id LIMIT 500")
def _(spark, sf):
    return jobs.claim_batch(order_queue(spark, sf), 500, fixed.QUEUE_STATUSES, "w-0", AT, 50, top_rows=50).select("id", "claimed_by")


@query("q3_claim_batch", f"SELECT id, processing_status, 'w-0' AS claimed_by, {AT_SQL} AS claimed_at FROM {_QUEUE_SQL} WHERE {_OPEN} AND claimed_by IS NULL AND id >= 50 ORDER BY id LIMIT 1000")
def _(spark, sf):
    claimed = jobs.claim_batch(order_queue(spark, sf), 1000, fixed.QUEUE_STATUSES, "w-0", AT, 50)
    return claimed.select("id", "processing_status", "claimed_by", F.col("claimed_at").cast("timestamp_ntz").alias("claimed_at"))


@query("q3_atomic_claims", f"SELECT id, 'claimed' AS processing_status, 1::BIGINT AS times FROM {_QUEUE_SQL} WHERE {_OPEN} AND claimed_by IS NULL")
def _(spark, sf):
    """Two workers claim at once from one queue until nothing is left; their claims, by id."""
    queue = order_queue(spark, sf)
    log = QueueLog.create(queue, f"{staged_dir(spark)}/q3-{uuid.uuid4().hex}", rows_per_part=5000)
    n = max(500, queue.count() // 6)

    def work(worker: str) -> None:
        mine = QueueLog(spark, log.folder)
        while mine.claim(n, fixed.QUEUE_STATUSES, worker, AT).count():
            pass

    with ThreadPoolExecutor(2) as workers:
        list(workers.map(work, ["a", "b"]))
    return log.history().groupBy("id").agg(F.lit("claimed").alias("processing_status"), F.count("*").alias("times"))


@query(
    "q4_normalize_jobs",
    f"SELECT product_page_url AS url, id AS url_id, 50 AS max_items, 12 AS wait_seconds, 3 AS max_retries, retry_count, product_type_id FROM {_QUEUE_SQL}",
)
def _(spark, sf):
    return jobs.jobs_of_queue(order_queue(spark, sf)).drop("searched_product_id")


@query(
    "q5_attach_pages",
    f"""SELECT o_orderkey AS url_id, coalesce(p.url, 'https://nowhere.example/' || o_orderkey) AS url, q.page_id, CASE WHEN q.page_id IS NULL THEN '{jobs.NO_PAGE}' END AS error
    FROM orders LEFT JOIN pages p ON p.page_id = o_orderkey LEFT JOIN (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url) q ON q.url = p.url""",
)
def _(spark, sf):
    pages = table(spark, sf, "pages")
    wanted = table(spark, sf, "orders").join(pages.select("page_id", "url"), F.col("page_id") == F.col("o_orderkey"), "left")
    url = F.coalesce("url", F.concat(F.lit("https://nowhere.example/"), F.col("o_orderkey").cast("string")))
    return jobs.attach_pages(jobs.normalize_jobs(wanted.select(url.alias("url"), F.col("o_orderkey").alias("url_id"))), pages).select("url_id", "url", "page_id", "error")


_OUTCOME_SQL = """(SELECT event_id AS url_id, CASE event_id % 5 WHEN 3 THEN 'raised' WHEN 4 THEN 'exhausted' ELSE 'result' END AS kind,
  event_type <> 'error' AS success, (user_id % 40) AS num_products, (user_id % 30) AS saved_to_db, CASE WHEN event_type = 'error' OR event_id % 5 >= 3 THEN 'error ' || event_id END AS error,
  (event_id % 4)::INTEGER AS retry_count, CASE WHEN event_id % 7 = 0 THEN 0 ELSE 3 END AS max_retries FROM events)"""


def event_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, kind = F.col("event_id"), F.col("event_id") % 5
    return table(spark, sf_dir, "events").select(
        i.alias("url_id"),
        F.when(kind == 3, "raised").when(kind == 4, "exhausted").otherwise("result").alias("kind"),
        (F.col("event_type") != "error").alias("success"),
        (F.col("user_id") % 40).alias("num_products"),
        (F.col("user_id") % 30).alias("saved_to_db"),
        F.when((F.col("event_type") == "error") | (kind >= 3), F.concat(F.lit("error "), i.cast("string"))).alias("error"),
        (i % 4).cast("int").alias("retry_count"),
        F.when(i % 7 == 0, 0).otherwise(3).alias("max_retries"),
    )


_STATE_SQL = f"""(SELECT *, CASE
    WHEN kind = 'result' AND success THEN 'completed'
    WHEN kind = 'result' THEN CASE WHEN max_retries > 0 AND retry_count + 1 < max_retries THEN 'retrying' ELSE 'failed' END
    WHEN kind = 'exhausted' AND retry_count >= max_retries THEN 'failed'
    WHEN retry_count + 1 <= max_retries THEN 'retrying' ELSE 'failed' END AS new_status,
  CASE WHEN kind = 'exhausted' AND retry_count >= max_retries THEN retry_count ELSE retry_count + 1 END AS new_retry_count,
  (kind = 'exhausted' AND retry_count >= max_retries) AS skipped FROM {_OUTCOME_SQL})"""


@query("q6_next_state", f"SELECT url_id, new_status, new_retry_count, (kind = 'result' AND success) AS new_success FROM {_STATE_SQL}")
def _(spark, sf):
    return jobs.next_state(event_outcomes(spark, sf)).select("url_id", "new_status", "new_retry_count", "new_success")


_UPDATE_SQL = f"""(SELECT url_id AS id, new_status AS processing_status, new_retry_count AS retry_count, (kind = 'result' AND success) AS success,
  CASE WHEN skipped THEN 0 WHEN kind = 'result' AND (success OR new_status = 'failed') THEN num_products END AS products_found,
  CASE WHEN skipped THEN 0 WHEN kind = 'result' AND (success OR new_status = 'failed') THEN saved_to_db END AS products_saved,
  CASE WHEN new_status = 'completed' THEN NULL WHEN skipped THEN 'Skipped after ' || retry_count || ' retries: ' || coalesce(error, '') ELSE error END AS error_message,
  CASE WHEN new_status IN ('completed', 'failed') THEN {AT_SQL} END AS processed_at, {AT_SQL} AS updated_at FROM {_STATE_SQL})"""


def _naive(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes])


@query("q7_queue_update", f"SELECT * FROM {_UPDATE_SQL}")
def _(spark, sf):
    return _naive(jobs.queue_update(jobs.next_state(event_outcomes(spark, sf)), AT))


@query(
    "s6_write_queue",
    f"""SELECT q.id, coalesce(u.processing_status, q.processing_status) AS processing_status, coalesce(u.retry_count, q.retry_count) AS retry_count,
      CASE WHEN u.id IS NULL THEN q.claimed_by END AS claimed_by, u.success, u.products_found, u.products_saved, u.error_message, u.processed_at, u.updated_at
    FROM {_QUEUE_SQL} q LEFT JOIN (SELECT * FROM {_UPDATE_SQL} WHERE id % 2 = 0) u ON u.id = q.id""",
)
def _(spark, sf):
    updates = jobs.queue_update(jobs.next_state(event_outcomes(spark, sf)), AT).where("id % 2 = 0")
    return _naive(tables.write_queue(order_queue(spark, sf), updates)).drop("product_type_id", "product_page_url", "claimed_at")


_STATS_SQL = """count(*) AS submitted, count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed,
  coalesce(sum(num_products) FILTER (success), 0)::BIGINT AS total_products_found, coalesce(sum(saved_to_db) FILTER (success), 0)::BIGINT AS total_saved_to_db"""


@query("a6_run_stats", f"SELECT {_STATS_SQL} FROM {_OUTCOME_SQL}")
def _(spark, sf):
    return jobs.run_stats(event_outcomes(spark, sf))


@query("a7_rollup_batches", f"SELECT {_STATS_SQL} FROM {_OUTCOME_SQL}")
def _(spark, sf):
    """Batches are told apart by retry_count; their totals are those of all."""
    rows = event_outcomes(spark, sf)
    batches = [jobs.run_stats(rows.where(F.col("retry_count") == i)) for i in range(4)]
    union = batches[0]
    for b in batches[1:]:
        union = union.unionByName(b)
    return jobs.rollup_batches(union)


@query(
    "a8_result_samples",
    f"""SELECT success, (row_number() OVER (PARTITION BY success ORDER BY url_id))::INTEGER AS place, url_id, CASE WHEN success THEN num_products END AS num_products,
      CASE WHEN success THEN saved_to_db END AS saved_to_db, CASE WHEN NOT success THEN coalesce(error, 'unknown error') END AS error
    FROM {_OUTCOME_SQL} QUALIFY place <= 5""",
)
def _(spark, sf):
    return jobs.result_samples(event_outcomes(spark, sf))


@query("a9_sample_jobs", f"SELECT id AS pos, product_page_url AS url FROM {_QUEUE_SQL} ORDER BY id LIMIT 3")
def _(spark, sf):
    return jobs.sample_jobs(order_queue(spark, sf).select(F.col("id").alias("pos"), F.col("product_page_url").alias("url")))


@query(
    "q8_process_queue",
    f"""SELECT o_orderkey AS id, CASE WHEN found THEN 'completed' ELSE 'failed' END AS processing_status,
      (CASE WHEN found THEN retry_count + 1 ELSE greatest(3, retry_count + 1) END)::INTEGER AS retry_count, found AS success, CASE WHEN found THEN n END AS products_found
    FROM (SELECT o_orderkey, (o_custkey % 5) AS retry_count, p.n, p.page_id IS NOT NULL AS found
      FROM orders LEFT JOIN (SELECT p_partkey // 20 AS page_id, count(*) AS n FROM part GROUP BY 1) p ON p.page_id = o_orderkey WHERE o_orderstatus <> 'F' AND o_custkey % 11 <> 0)""",
)
def _(spark, sf):
    """The whole queue, until nothing can be claimed, in several batches: page n of the parts is at the address of order n, the
    others fail."""
    n = table(spark, sf, "orders").count() // 4
    empty = spark.createDataFrame([], PRODUCT_ROWS)
    run = queue_run.process_queue(order_queue(spark, sf), part_pages(table(spark, sf, "part")), empty, AT, batch_size=max(1, n))
    done = run.queue.where("updated_at IS NOT NULL")
    return done.select("id", "processing_status", "retry_count", "success", F.when(F.col("success"), F.col("products_found")).alias("products_found"))
