"""Six ways to find product candidates on a page. Each gives (page_id, rung, pos, product fields) of valid candidates, the
first `max_items` of a page by `pos`, before any merging.

`nodes` are node_rows() of the `parsed` pages. What JSON says takes `urls` (page_id, url), too. Elements meet what they are inside of
by aligned blocks of their numbers (containment.py), an equi-join, so the work grows neither with depth nor with cards times elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import clean_text, extract_price_text, first_full, infer_in_stock, or_null, parse_float, parse_int, parse_price, truncate
from ..functions.urls import is_potential_product_href, to_absolute
from ..schemas import CANDIDATES, PRODUCT_NAMES
from ..sources.staged import staged
from .containment import folded_inside, following, inside
from .json_walk import walk_json
from .nodes import text_of_element, with_text
from .products import first_per_page, valid_products
from .selectors import attr, first_nonempty_selector, looks_like_card, matches, matching_marks, matching_ranks

DOM, JSON_LD, MICRODATA, INLINE_JSON, HEURISTIC, LINKED_IMAGES = range(1, 7)
CARD_TAGS, SCOPE_TAGS = ["li", "div", "article"], ["main", "section", "div"]
ANY_IMAGE = "img[src], img[data-src], img[data-original], img[data-srcset]"


def _said() -> Column:
    """Content, label, or text of an element."""
    return clean_text(first_full(attr("content"), attr("aria-label"), F.col("text")))


def _shown() -> Column:
    return clean_text(first_full(attr("content"), F.col("text")))


def _description() -> Column:
    return F.when(F.length(_shown()) > fixed.DESCRIPTION_LEAST, truncate(_shown(), fixed.DESCRIPTION_CHARS))


def card_values() -> dict[str, tuple[list[str], Column]]:
    """What is looked up in a card: selectors in order, and the value of an element. Of each selector only the first
    match in the card counts, and the first selector whose match has a value."""
    s = fixed.SELECTORS
    source = first_full(*[attr(a) for a in ("src", "data-src", "data-original", "data-srcset", "content")])
    return {
        "anchor_title": (["a[href]"], clean_text(first_full(attr("title"), F.col("text")))),
        "image_title": (["img"], clean_text(attr("alt"))),
        "said_title": (s["title"], _said()),
        "link": (s["link"], first_full(attr("href"), attr("content"))),
        "image": (s["image"], source),
        "price": (s["price"], _shown()),
        "currency": (s["currency"], _shown()),
        "rating": (s["rating"], _said()),
        "reviews": (s["reviews"], _said()),
        "availability": (s["availability"], _said()),
        "brand": (s["brand"], _said()),
        "brand_attr": (s["brand"], attr("data-brand")),
        "sku": (s["sku"], _said()),
        "sku_attr": (s["sku"], attr("data-sku")),
        "sku_other": (s["sku"], attr("data-product-sku")),
        "description": (s["description"], _description()),
    }


def card_fields(cards: DataFrame, nodes: DataFrame, parsed: DataFrame) -> DataFrame:
    """(page_id, node_id, product fields) of distinct cards (page_id, node_id, subtree_end, piece_start, piece_count).

    Joins of elements, cards and texts are by sort and merge. Spark takes what is read from arrays for as large as its share
    of the compressed file, a small part of what it is, and would send it through the driver as a broadcast.
    """
    looked_up = card_values()

    # the first match of each selector in each card, from places and ranks only
    marked = nodes.join(cards.select("page_id").distinct(), "page_id", "left_semi")
    marks = F.inline(matching_marks([group for group, _ in looked_up.values()]))
    marked = marked.select("page_id", F.col("node_id").alias("at"), marks)
    first = staged(folded_inside(marked, cards, ["field", "rank"], {"at": (F.min, F.col("at"))}), "first_matches")

    # texts and values are read of these alone, once an element
    wanted = first.groupBy("page_id", "at").agg(F.collect_list(F.struct("node_id", "field", "rank")).alias("wanted"))
    hits = nodes.select("page_id", F.col("node_id").alias("at"), "attrs", "piece_start", "piece_count").join(wanted.hint("merge"), ["page_id", "at"])

    def value(of: Column) -> Column:
        return F.coalesce(*[F.when(of["field"] == i, v) for i, (_, v) in enumerate(looked_up.values())])

    told = F.transform("wanted", lambda of: F.struct(of["node_id"].alias("node_id"), of["field"].alias("field"), of["rank"].alias("rank"), value(of).alias("value")))
    by_rank = with_text(hits, parsed).select("page_id", F.inline(told)).where("value IS NOT NULL AND value <> ''")
    wide = by_rank.groupBy("page_id", "node_id").agg(
        *[F.min_by("value", F.when(F.col("field") == i, F.col("rank"))).alias(f"v_{name}") for i, name in enumerate(looked_up)]
    )
    rows = cards.drop("subtree_end").join(wide.hint("merge"), ["page_id", "node_id"], "left").join(parsed.select("page_id", "url", "pieces").hint("merge"), "page_id")
    v = lambda name: F.col(f"v_{name}")
    rows = rows.withColumn("raw_price", F.coalesce(v("price"), extract_price_text(text_of_element())))
    price = parse_price(F.col("raw_price"))
    return rows.select(
        "page_id",
        "node_id",
        F.coalesce(v("anchor_title"), v("image_title"), v("said_title")).alias("title"),
        to_absolute(F.col("url"), v("link")).alias("product_url"),
        to_absolute(F.col("url"), v("image")).alias("image_url"),
        price["price"].alias("price"),
        F.coalesce(v("currency"), price["currency"]).alias("currency"),
        "raw_price",
        parse_float(v("rating")).alias("rating"),
        parse_int(v("reviews")).alias("review_count"),
        infer_in_stock(v("availability")).alias("in_stock"),
        F.coalesce(v("brand"), v("brand_attr")).alias("brand"),
        F.coalesce(v("sku"), v("sku_attr"), v("sku_other")).alias("sku"),
        v("description").alias("description"),
    )


def _candidates(rows: DataFrame, rung: int, max_items: int) -> DataFrame:
    rows = valid_products(rows.withColumn("rung", F.lit(rung)))
    return first_per_page(rows.select("page_id", "rung", "pos", *PRODUCT_NAMES), max_items)


def _pos(*columns) -> Column:
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("bigint") for c in columns]).alias("pos")


def _of_cards(places: DataFrame, nodes: DataFrame, parsed: DataFrame, rung: int, max_items: int) -> DataFrame:
    """Candidates of the cards at `places` (page_id, node_id, pos), which may repeat a card; its fields are read once.

    Places and cards are narrow, and written before they are used again: plans that spell them out at each use take longer
    to make than to run.
    """
    places = staged(places, "places")
    spans = nodes.select("page_id", "node_id", "subtree_end", "piece_start", "piece_count")
    cards = staged(places.select("page_id", "node_id").distinct().join(spans, ["page_id", "node_id"]), "cards")
    return _candidates(places.join(card_fields(cards, nodes, parsed), ["page_id", "node_id"]), rung, max_items)


def extract_dom(nodes: DataFrame, parsed: DataFrame, max_items: int = fixed.MAX_ITEMS) -> DataFrame:
    """Cards within result containers; on pages without containers, cards anywhere; failing these, what looks like one."""
    group = fixed.SELECTORS["product_cards"]
    ranked = staged(nodes.where("displayed").select("page_id", "node_id", F.explode(matching_ranks(group)).alias("rank")), "ranked")
    containers = staged(first_nonempty_selector(nodes, fixed.SELECTORS["result_containers"]), "containers")
    contained = inside(ranked.withColumnRenamed("node_id", "card"), containers.drop("rank"), "card")
    contained = contained.select("page_id", F.col("card").alias("node_id"), _pos("node_id", "rank", "card"))
    with_containers = containers.select("page_id").distinct()

    loose = ranked.join(with_containers, "page_id", "left_anti")
    best = loose.groupBy("page_id").agg(F.min("rank").alias("rank"))
    loose = loose.join(best, ["page_id", "rank"]).select("page_id", "node_id", _pos(F.lit(0), "rank", "node_id"))

    found = staged(contained.unionByName(loose), "found_places")
    pages_found = found.select("page_id").distinct()
    rest = nodes.where(F.col("tag").isin(CARD_TAGS)).join(pages_found, "page_id", "left_anti")
    guessed = looks_like_card(nodes, rest, parsed).select("page_id", "node_id", _pos(F.lit(0), F.lit(0), "node_id"))

    usable = nodes.where(~F.col("blacklisted")).select("page_id", "node_id")
    places = found.unionByName(guessed).join(usable, ["page_id", "node_id"])
    return _of_cards(places, nodes, parsed, DOM, max_items)


def extract_heuristic(nodes: DataFrame, parsed: DataFrame, max_items: int = fixed.MAX_ITEMS) -> DataFrame:
    """What looks like a card, once for each section that holds it."""
    usable = nodes.where(F.col("displayed") & ~F.col("blacklisted"))
    scopes = usable.where(F.col("tag").isin(SCOPE_TAGS)).select("page_id", "node_id", "subtree_end")
    cards = usable.where(F.col("tag").isin(CARD_TAGS))
    cards = looks_like_card(nodes, cards, parsed).withColumnRenamed("node_id", "card")
    places = inside(cards, scopes, "card").select("page_id", F.col("card").alias("node_id"), _pos("node_id", "card"))
    return _of_cards(places, nodes, parsed, HEURISTIC, max_items)


def extract_linked_images(nodes: DataFrame, parsed: DataFrame, max_items: int = fixed.MAX_ITEMS) -> DataFrame:
    """Anchors with a product-like address and an image inside, or else inside their parent."""
    anchors = nodes.where(F.col("displayed") & ~F.col("blacklisted") & matches("a[href]")).join(parsed.select("page_id", "url", "pieces"), "page_id")
    anchors = anchors.withColumn("href", to_absolute(F.col("url"), attr("href"))).where(is_potential_product_href(F.col("href")))
    anchors = anchors.select("page_id", "node_id", "parent_id", "url", "href", clean_text(first_full(attr("title"), text_of_element())).alias("title"))
    source = first_full(*[attr(a) for a in ("src", "data-src", "data-original", "data-srcset")])
    image = F.when(matches(ANY_IMAGE), F.struct("node_id", source.alias("source")))
    first = nodes.select("page_id", "node_id", "subtree_end", following(image).alias("i")).where(F.col("i.node_id") < F.col("subtree_end"))
    own = first.select("page_id", "node_id", F.struct("i.source").alias("own"))
    near = first.select("page_id", F.col("node_id").alias("parent_id"), F.struct("i.source").alias("near"))
    rows = anchors.join(own, ["page_id", "node_id"], "left").join(near, ["page_id", "parent_id"], "left")
    rows = rows.withColumn("img", F.coalesce("own", "near")).where("img IS NOT NULL")
    blank = {f.name: f.dataType for f in CANDIDATES.fields if f.name in PRODUCT_NAMES}
    return _candidates(
        rows.select(
            "page_id",
            _pos("node_id"),
            "title",
            F.col("href").alias("product_url"),
            to_absolute(F.col("url"), F.col("img.source")).alias("image_url"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in blank.items() if name not in ("title", "product_url", "image_url")],
        ),
        LINKED_IMAGES,
        max_items,
    )


def _of_json(raw: DataFrame, urls: DataFrame, rung: int, max_items: int) -> DataFrame:
    rows = raw.withColumnRenamed("url", "found_url").join(urls, "page_id")
    parsed = parse_price(F.col("__price"))
    rows = rows.withColumn("__price", F.col("price"))
    return _candidates(
        rows.select(
            "page_id",
            _pos("seq"),
            clean_text(F.col("title")).alias("title"),
            to_absolute(F.col("url"), F.col("found_url")).alias("product_url"),
            to_absolute(F.col("url"), F.col("image")).alias("image_url"),
            parsed["price"].alias("price"),
            F.coalesce(clean_text(F.col("currency")) if rung == INLINE_JSON else or_null(F.col("currency")), parsed["currency"]).alias("currency"),
            F.col("__price").alias("raw_price"),
            parse_float(F.col("rating")).alias("rating"),
            parse_int(F.col("review_count")).alias("review_count"),
            infer_in_stock(F.col("availability")).alias("in_stock"),
            clean_text(F.col("brand")).alias("brand"),
            clean_text(F.col("sku")).alias("sku"),
            clean_text(F.col("description")).alias("description"),
        ),
        rung,
        max_items,
    )


def _scripts(parsed: DataFrame, types: list[str], most: int | None = None) -> DataFrame:
    fits = lambda s: s["type"].isin(types) & (s["text"] != "") & (F.length(s["text"]) <= most if most else F.lit(True))
    texts = F.transform(F.filter("scripts", fits), lambda s: s["text"])
    return parsed.select("page_id", texts.alias("texts")).where(F.size("texts") > 0)


def extract_jsonld(parsed: DataFrame, urls: DataFrame, max_items: int = fixed.MAX_ITEMS, strict: bool = True) -> DataFrame:
    return _of_json(walk_json(_scripts(parsed, ["application/ld+json"]), "ld", strict), urls, JSON_LD, max_items)


def extract_inline_json(parsed: DataFrame, urls: DataFrame, max_items: int = fixed.MAX_ITEMS, strict: bool = True) -> DataFrame:
    scripts = _scripts(parsed, ["application/json", "text/json", "text/plain"], fixed.SCRIPT_CHARS)
    return _of_json(walk_json(scripts, "generic", strict), urls, INLINE_JSON, max_items)


#: Properties by field, and whether the first or the last value counts
MICRODATA_FIRST = {"title": ["name"], "link": ["url", "link"], "image": ["image"], "brand": ["brand"], "sku": ["sku"]}
MICRODATA_LAST = {
    "currency": ["pricecurrency", "currency"],
    "availability": ["availability"],
    "description": ["description"],
    "rating": ["ratingvalue"],
    "review_count": ["reviewcount", "ratingcount"],
}


def extract_microdata(nodes: DataFrame, parsed: DataFrame, max_items: int = fixed.MAX_ITEMS) -> DataFrame:
    """Elements that are products by itemtype, with the properties beneath them, those of nested scopes too."""
    scopes = nodes.where(~F.col("blacklisted") & matches('[itemscope][itemtype*="Product" i]'))
    scopes = scopes.select("page_id", "node_id", "subtree_end", attr("itemid").alias("itemid"))
    key = F.lower(attr("itemprop"))
    value = clean_text(first_full(attr("content"), attr("href"), attr("src"), F.col("text")))
    told = with_text(nodes.where(attr("itemprop").isNotNull()), parsed)
    # a brand that says almost nothing is read from the first name beneath it
    name = F.when(matches('[itemprop="name"]'), F.struct("node_id", _shown().alias("name")))
    props = told.select("page_id", F.col("node_id").alias("at"), key.alias("key"), value.alias("value"), "subtree_end", following(name).alias("nested"))
    beneath = F.col("nested.node_id") < F.col("subtree_end")
    thin = (F.col("key") == "brand") & (F.coalesce(F.length("value"), F.lit(0)) <= 2) & F.coalesce(beneath, F.lit(False))
    props = props.select("page_id", "at", "key", F.when(thin, F.col("nested.name")).otherwise(F.col("value")).alias("value"))
    # the first and the last value of each property; a price counts even if it is empty
    props = props.where(F.col("value").isNotNull() | (F.col("key") == "price"))
    found = folded_inside(props, scopes, ["key"], {"first": (F.min, F.struct("at", "value")), "last": (F.max, F.struct("at", "value"))})
    of = lambda keys, end: F.when(F.col("key").isin(keys), F.col(end))
    folded = found.groupBy("page_id", "node_id").agg(
        *[F.min(of(keys, "first"))["value"].alias(name) for name, keys in MICRODATA_FIRST.items()],
        *[F.max(of(keys, "last"))["value"].alias(name) for name, keys in MICRODATA_LAST.items()],
        F.max(of(["price"], "last"))["value"].alias("raw_price"),
    )
    rows = scopes.join(folded, ["page_id", "node_id"], "left").join(parsed.select("page_id", "url"), "page_id")
    price = parse_price(F.col("raw_price"))
    return _candidates(
        rows.select(
            "page_id",
            _pos("node_id"),
            "title",
            to_absolute(F.col("url"), F.coalesce("itemid", "link")).alias("product_url"),
            to_absolute(F.col("url"), F.col("image")).alias("image_url"),
            price["price"].alias("price"),
            F.coalesce("currency", price["currency"]).alias("currency"),
            "raw_price",
            parse_float(F.col("rating")).alias("rating"),
            parse_int(F.col("review_count")).alias("review_count"),
            infer_in_stock(F.col("availability")).alias("in_stock"),
            "brand",
            "sku",
            clean_text(truncate(F.col("description"), fixed.DESCRIPTION_CHARS)).alias("description"),
        ),
        MICRODATA,
        max_items,
    )
