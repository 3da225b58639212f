"""Listing pages made of `part`, twenty parts a page, one template for each strategy of the ladder (FIXTURES.md, 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_PAGE = 20
BASE = "https://shop.example.com"


def _f(template: str) -> Column:
    """`template` with {columns} filled in."""
    pieces, at = [], 0
    while (i := template.find("{{", at)) >= 0:
        j = template.index("}}", i)
        pieces += [F.lit(template[at:i]), F.col(template[i + 2 : j])]
        at = j + 2
    return F.concat(*pieces, F.lit(template[at:]))


CARDS = [
    '<li class="product"><a href="{{path}}" title="{{p_name}}">{{p_name}}</a><img src="{{image}}"><span class="price">${{price}}</span><span class="brand">{{p_brand}}</span><span class="stock">In stock</span></li>',
    '{"@type":"ListItem","position":{{place}},"item":{"x":1},"name":"{{p_name}}","url":"{{path}}","image":["{{image}}"],"offers":[{"price":"{{price}}","priceCurrency":"EUR","availability":"https://schema.org/InStock"}],"brand":{"name":"{{p_brand}}"},"sku":"{{sku}}"}',
    '<span itemscope itemtype="http://data-vocabulary.org/Product"><span itemprop="name">{{p_name}}</span><link itemprop="url" href="{{path}}"><img itemprop="image" src="{{image}}"><meta itemprop="price" content="{{price}}"><meta itemprop="priceCurrency" content="GBP"><span itemprop="brand">{{p_brand}}</span></span>',
    '{"name":"{{p_name}}","url":"{{path}}","price":"{{price}}","currency":"CAD","sku":"{{sku}}"}',
    '<li><a href="{{path}}"><img src="{{image}}" alt="{{p_name}}"></a> ${{price}}</li>',
    '<a href="{{path}}" title="{{p_name}}"><img src="{{image}}"></a>',
]
PAGES = [
    ('<html><body><nav><a href="/about">About</a></nav><ul class="products">', "", "</ul></body></html>"),
    ('<html><head><script type="application/ld+json">{"@type":"ItemList","itemListElement":[', ",", "]}</script></head><body><p>List</body></html>"),
    ("<html><body>", "", "</body></html>"),
    ('<html><body><p>Shop<script type="application/json">{"products":[', ",", "]}</script></body></html>"),
    ('<html><body><section><div class="item-banner">x</div><ul>', "", "</ul></section></body></html>"),
    ("<html><body><main><section>", "", "</section></main></body></html>"),
]


#: Pages of one kind that show all fields of a product, by name: before the cards, the card, between them, after them
FULL = {
    "cards": (
        '<html><body><ul class="products">',
        '<li class="product"><a href="{{path}}" title="{{p_name}}">x</a><img data-src="{{image}}"><span class="price">${{price}}</span><span class="rating">Rated {{stars}} out of 5</span><span class="reviews">{{reviews}} reviews</span><span class="brand">{{p_brand}}</span><span data-sku="{{sku}}"></span><div class="description">{{p_name}}, described at some length</div><span class="stock">Out of stock</span></li>',
        "",
        "</ul></body></html>",
    ),
    "ld": (
        '<html><head><script type="application/ld+json">[',
        '{"@type":"Product","name":"{{p_name}}","url":"{{path}}","image":"{{image}}","offers":{"price":"{{price}}","priceCurrency":"EUR","availability":"https://schema.org/OutOfStock"},"aggregateRating":{"ratingValue":"{{stars}}","reviewCount":"{{reviews}}"},"brand":"{{p_brand}}","sku":"{{sku}}","description":" {{p_name}},  described at some length"}',
        ",",
        "]</script></head><body></body></html>",
    ),
    "generic": (
        '<html><body><script type="application/json">{"products":[',
        '{"productName":"{{p_name}}","link":{"href":"{{path}}"},"thumbnail":{"src":"{{image}}"},"salePrice":{"amount":"{{price}}"},"currencyCode":"CAD","manufacturer":"{{p_brand}}","itemId":"{{sku}}","summary":"{{p_name}}, described at some length","averageRating":"{{stars}}","numberOfReviews":"{{reviews}}","stockStatus":"out of stock"}',
        ",",
        "]}</script></body></html>",
    ),
    "blobs": ('<html><body><script type="application/json">var shown = ', '{"name":"{{p_name}}","url":"{{path}}"}', "; var next = ", "; {broken</script></body></html>"),
    "hidden": ("<html><body>", "<div {{hide}}><b>{{p_name}}</b></div>", "", "</body></html>"),
}


def _rows(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        "*",
        F.floor(key / PER_PAGE).cast("bigint").alias("page_id"),
        (key % PER_PAGE).cast("string").alias("place"),
        F.concat(F.lit("/product/"), key.cast("string")).alias("path"),
        F.concat(F.lit("/img/"), key.cast("string"), F.lit(".png")).alias("image"),
        F.concat(F.lit("S-"), key.cast("string")).alias("sku"),
        F.format_string("%.2f", "p_retailprice").alias("price"),
        F.concat((key % 5).cast("string"), F.lit("."), (key % 9).cast("string")).alias("stars"),
        (key * 7).cast("string").alias("reviews"),
        F.when(key % 3 == 0, 'style="COLOR: red; display : none"').when(key % 3 == 1, "hidden").otherwise("").alias("hide"),
    )


def _paged(rows: DataFrame, card: Column) -> DataFrame:
    """(page_id, cards): each page's cards in order."""
    pages = rows.select("page_id", F.col("p_partkey").alias("at"), card.alias("card")).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("at", "card"))).alias("cards"))
    return pages.select("page_id", F.col("cards.card").alias("cards"))


def _addressed(html: Column) -> list[Column]:
    return [F.col("page_id"), F.concat(F.lit(f"{BASE}/list/"), F.col("page_id").cast("string")).alias("url"), html.alias("html")]


def full_pages(part: DataFrame, kind: str) -> DataFrame:
    """(page_id, url, html) of pages of a kind of FULL."""
    head, card, between, foot = FULL[kind]
    return _paged(_rows(part), _f(card)).select(*_addressed(F.concat(F.lit(head), F.array_join("cards", between), F.lit(foot))))


def part_pages(part: DataFrame) -> DataFrame:
    """(page_id, url, html)"""
    kind = (F.col("page_id") % len(CARDS)).cast("int")
    pages = _paged(_rows(part), F.coalesce(*[F.when(kind == i, _f(c)) for i, c in enumerate(CARDS)]))
    html = F.coalesce(*[F.when(kind == i, F.concat(F.lit(head), F.array_join("cards", sep), F.lit(foot))) for i, (head, sep, foot) in enumerate(PAGES)])
    return pages.select(*_addressed(html))
