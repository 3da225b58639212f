import json
import random
import re
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweb.functions import fixed
from tallyweb.operators import strategies as s
from tallyweb.operators.containment import folded_inside, following, inside
from tallyweb.operators.json_walk import blobs, deep_loads, pieces
from tallyweb.operators.nodes import node_rows, parse_nodes, with_text
from tallyweb.operators.products import cap_per_page, merge_by_url
from tallyweb.operators.selectors import _parts, matches, matching_marks, matching_ranks
from tallyweb.plans import ladder

SCHEMA = "page_id long, url string, html string"


def pages_of(spark, *htmls):
    return spark.createDataFrame([(i, f"https://shop.example.com/list/{i}", h) for i, h in enumerate(htmls)], SCHEMA)


def nodes_of(spark, html):
    parsed = parse_nodes(pages_of(spark, html))
    return {r["node_id"]: r for r in with_text(node_rows(parsed), parsed).orderBy("node_id").collect()}


def card(i, extra=""):
    return f'<li class="product"><a href="/product/{i}" title="Thing {i}">Thing</a><span class="price">$5.0{i % 10}</span>{extra}</li>'


def test_tree_of_unclosed_tags(spark):
    nodes = nodes_of(spark, '<body><p>one<b>two<p>three<ul><li>a<li>b</ul><script>"</p>"</script><div hidden>no<i>no</i></div>')
    tags = [(n["tag"], n["text"].strip(), n["displayed"]) for n in nodes.values()]
    assert [t for t in tags if t[0] == "p"] == [("p", "onetwo", True), ("p", "three", True)]
    assert [t for t in tags if t[0] == "li"] == [("li", "a", True), ("li", "b", True)]
    assert [t[2] for t in tags if t[0] in ("div", "i", "script")] == [False, False, False]


def test_null_and_empty_pages(spark):
    rows = parse_nodes(pages_of(spark, None, "", "text only")).collect()
    assert [len(r["nodes"]) for r in rows] == [0, 0, 0]
    assert ladder.run_ladder(pages_of(spark, None, "")).count() == 0


def test_sections_refused_within_five_steps(spark):
    deep = "<footer><i><i><i><i><a>in</a><i><i><a>out</a></i></i></i></i></i></i></footer>"
    flags = [n["blacklisted"] for n in nodes_of(spark, deep).values() if n["tag"] == "a"]
    assert flags == [True, False]


@pytest.mark.parametrize(
    ("selector", "tag", "attrs", "fits"),
    [
        ("ul.products", "ul", {"class": "a products"}, True), ("ul.products", "ul", {"class": "products2"}, False),
        ('div[class*="Item" i]', "div", {"class": "my-ITEM"}, True), ("a[href]", "a", {"href": ""}, True), ("a[href]", "a", {}, False),
        ('[itemscope][itemtype*="schema.org/Product" i]', "p", {"itemscope": "", "itemtype": "http://Schema.org/product"}, True),
        ("img[src], img[data-src]", "img", {"data-src": "x"}, True), ('a[x="y"]', "a", {"x": "yy"}, False),
    ],
)
def test_selectors(spark, selector, tag, attrs, fits):
    df = spark.createDataFrame([(tag, attrs)], "tag string, attrs map<string,string>")
    assert df.select(matches(selector)).first()[0] is fits


def test_no_text_is_kept_once_for_each_element_around_it(spark, monkeypatch):
    """What is staged grows with the page, not with its depth."""
    kept, made = {}, ladder.staged
    monkeypatch.setattr(ladder, "staged", lambda df, name: kept.setdefault(name, made(df, name)))
    deep = "<div>" * 100 + card(1, "<p>" + "words " * 1000 + "</p>") + "</div>" * 100
    assert ladder.run_ladder(pages_of(spark, deep)).count() == 1
    assert "text" not in kept["nodes"].columns
    assert kept["parsed_pages"].select(F.aggregate("pieces", F.lit(0), lambda n, p: n + F.length(p))).first()[0] < 8000


def test_texts_of_nested_elements(spark):
    nodes = nodes_of(spark, "<div>a<b>b&amp;<i></i></b><script>x</script><p>c<br>d</p>\U0001f600</div><div></div>")
    assert [n["text"] for n in nodes.values()] == ["ab&\nc\nd\n\U0001f600", "b&", "", "", "c\nd", "", ""]


def test_hidden_and_nested_cards(spark):
    html = f'<div class="products"><ul class="products">{card(1)}<li class="product" style="display: none"><a href="/product/2">No</a></li></ul></div>'
    found = ladder.run_ladder(pages_of(spark, html)).collect()
    assert {r["product_url"] for r in found} == {"https://shop.example.com/product/1"}


def test_cap_comes_before_the_merge(spark):
    sixty = "<ul class='products'>" + "".join(card(i) for i in range(60)) + "</ul>"
    pairs = "<ul class='products'>" + "".join(card(i // 2) for i in range(60)) + "</ul>"
    counts = {r["page_id"]: r["n"] for r in ladder.products_of(ladder.run_ladder(pages_of(spark, sixty, pairs))).groupBy("page_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 50, 1: 25}


def test_footer_links_are_no_products(spark):
    assert ladder.run_ladder(pages_of(spark, '<footer><a href="/product/1"><img src="i.png"></a></footer>')).count() == 0


def test_pages_that_say_so_have_nothing_to_save(spark):
    pages = pages_of(spark, "<p>No results found", "<p>prose")
    empty = ladder.products_of(ladder.run_ladder(pages))
    got = {r["page_id"]: (r["num_products"], r["saved_to_db"]) for r in ladder.page_results(pages, empty).collect()}
    assert got == {0: (0, None), 1: (0, 0)}


def test_microdata_first_and_last(spark):
    html = """<span itemscope itemtype="http://x.org/Product"><b itemprop="name">A1</b><b itemprop="name">B</b><a itemprop="url" href="/product/1">u</a>
      <b itemprop="price">3</b><b itemprop="price"></b><b itemprop="currency">EUR</b><b itemprop="currency">USD</b><b itemprop="brand">x<i itemprop="name">Maker</i></b></span>"""
    parsed = parse_nodes(pages_of(spark, html))
    r = s.extract_microdata(node_rows(parsed), parsed).first()
    assert (r["title"], r["raw_price"], r["currency"]) == ("A1", None, "USD")


def test_json_quirks(spark):
    html = """<script type="application/json">{"items":[{"name":"One","url":"/product/1","id":7,"items":[{"name":"Lost","url":"/product/9"}]},
      {"name":"Two","url":"/product/2","price":{"amount":4}},{"name":[],"url":"/product/3"}]}</script>"""
    pages = pages_of(spark, html)
    parsed, of = parse_nodes(pages), pages.select("page_id", "url")
    strict = s.extract_inline_json(parsed, of).collect()
    assert [(r["title"], r["price"]) for r in strict] == [("Two", 4.0)]
    loose = s.extract_inline_json(parsed, of, strict=False).orderBy("pos").collect()
    assert [r["title"] for r in loose] == ["One", "Lost", "Two"]


def test_blobs():
    assert blobs('{"a": 1}') == [{"a": 1}]
    assert blobs('x = {"a": 1}; y = [2];') == [{"a": 1}, [2]]
    assert blobs("nothing") == []


@given(st.text(alphabet='{}[]",:1 a', max_size=40))
def test_pieces_are_the_shortest_matches(text):
    assert list(pieces(text)) == re.findall(r"\{.*?\}|\[.*?\]", text, re.DOTALL)


@given(st.one_of(st.text(alphabet='{}[]",:1.e- a\\n', max_size=25), st.recursive(st.none() | st.booleans() | st.floats() | st.text(), lambda x: st.lists(x) | st.dictionaries(st.text(), x)).map(json.dumps)))
def test_deep_loads_is_loads(text):
    def read(f):
        try:
            return repr(f(text))
        except ValueError:
            return "no JSON"

    assert read(deep_loads) == read(json.loads)


def test_deep_and_broken_json(spark):
    began = time.time()
    assert blobs("{" * 500_000) == blobs("[{" * 250_000) == [] and blobs("{" * 500_000 + "[2]") == [[2]]
    (deep,) = blobs("[" * 100_000 + "7" + "]" * 100_000)
    for _ in range(100_000):
        (deep,) = deep
    assert deep == 7 and time.time() - began < 5
    product = '{"@type":"Product","name":"Lamp","url":"/product/1"}'
    wrap = lambda text: f'<script type="application/ld+json">{text}</script>'
    nested = '{"itemListElement":[' * 20_000 + product + "]}" * 20_000
    too_deep = '{"@type":"Product","name":{"a":' + "[" * 20_000 + "]" * 20_000 + '},"url":"/product/2"}'
    htmls = [wrap(nested), wrap("{" * 500_000), wrap("[" * 100_000), wrap(too_deep), wrap(product), '<script type="application/json">{"price":{"value":' + "[" * 20_000 + "]" * 20_000 + '},"name":"Deep","url":"/product/3"}</script>']
    for strict in (True, False):
        rows = ladder.run_ladder(pages_of(spark, *htmls), strict=strict).collect()
        assert sorted((r["page_id"], r["title"]) for r in rows) == [(0, "Lamp"), (4, "Lamp")]


def test_strategies_keep_their_plans_small(spark):
    parsed = ladder.parsed_pages(pages_of(spark, card(1), card(2)))
    nodes = ladder.staged_nodes(parsed)
    for extract in (s.extract_dom, s.extract_heuristic):
        plan = extract(nodes, parsed)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") <= 10


def test_no_elements_of_cards_are_broadcast(spark, monkeypatch):
    """However small Spark takes them for; of the ids of pages it may decide by their size."""
    plans, made = [], s.staged
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(s, "staged", lambda df, name: plans.append(plan(df)) or made(df, name))
    parsed = ladder.parsed_pages(pages_of(spark, card(1) + card(2), card(3), "<p>none"))
    nodes = node_rows(parsed)
    fields = s.card_fields(nodes.where("tag = 'li'").select("page_id", "node_id", "subtree_end", "piece_start", "piece_count"), nodes, parsed)
    joins = re.findall(r"\w+Join .*", "\n".join([*plans, plan(fields)]))
    assert len(plans) == 1 and sum("SortMergeJoin" in j for j in joins) == 5
    assert all("SortMergeJoin" in j or "LeftSemi" in j for j in joins)
    assert sorted(map(tuple, fields.select("page_id", "title", "price").collect())) == [(0, "Thing 1", 5.01), (0, "Thing 2", 5.02), (1, "Thing 3", 5.03)]


def test_markup_that_the_tokeniser_gives_up_on(spark):
    htmls = ["<p>a</p><![if x]><p>b</p>", "<![foo[<p>", "<!doctype [<!x", "</", "<a " + "b" * 100_000, card(1)]
    assert parse_nodes(pages_of(spark, *htmls)).count() == len(htmls)


def test_containment_by_parents(spark):
    """Random trees, deep and wide ones: what is inside, what is folded there and what comes first, by parent pointers."""
    rnd, rows = random.Random(5), []
    for page, (n, reach) in enumerate([(1, 1), (2, 1), (70, 1), (600, 2), (900, 30), (1500, 1500)]):
        path, parents = [], []
        for i in range(n):
            del path[max(0, len(path) - rnd.randrange(reach)) :]
            parents.append(path[-1] if path else None)
            path.append(i)
        ends = [i + 1 for i in range(n)]
        for i in reversed(range(n)):
            if parents[i] is not None:
                ends[parents[i]] = max(ends[parents[i]], ends[i])
        rows += [(page, i, parents[i], ends[i], rnd.randrange(3), rnd.random() < 0.3) for i in range(n)]
    df = spark.createDataFrame(rows, "page_id long, node_id int, parent_id int, subtree_end int, kind int, holder boolean")
    parent = {(p, i): up for p, i, up, *_ in rows}
    kind, holder = {(p, i): k for p, i, _, _, k, _ in rows}, {(p, i) for p, i, *_, h in rows if h}
    pairs, low = [], {}
    for p, i in parent:
        up = parent[p, i]
        while up is not None:
            if (p, up) in holder:
                pairs.append((p, up, i))
                low[p, up, kind[p, i]] = min(low.get((p, up, kind[p, i]), i), i)
            up = parent[p, up]
    elements, holders = df.select("page_id", F.col("node_id").alias("at"), "kind"), df.where("holder").select("page_id", "node_id", "subtree_end")
    assert sorted(map(tuple, inside(elements, holders).select("page_id", "node_id", "at").collect())) == sorted(pairs) and len(pairs) > 3000
    folded = folded_inside(elements, holders, ["kind"], {"low": (F.min, F.col("at"))})
    assert {tuple(r)[:3]: r["low"] for r in folded.select("page_id", "node_id", "kind", "low").collect()} == low
    first = df.select("page_id", "node_id", "subtree_end", "holder", following(F.when(F.col("kind") == 1, F.col("node_id"))).alias("next")).where("holder AND next < subtree_end")
    assert {(r["page_id"], r["node_id"], 1): r["next"] for r in first.collect()} == {k: v for k, v in low.items() if k[2] == 1}


def test_deep_pages_are_linear(spark):
    """100,000 nested elements, with marked cards, links and hidden ends: rows and time grow with the elements alone."""
    began = time.time()
    deep = "<div>" * 100_000 + '<a href="/product/1" title="Thing"><img src="i.png"></a>' + "<p></i>" * 10_000
    unclosed = '<div class="product">' * 3_000 + '<a href="/product/1" title="Thing">T</a><img src="i.png">' + "</div>" * 3_000
    parsed = ladder.parsed_pages(pages_of(spark, deep, unclosed, card(1)))
    got = {r["page_id"]: r for r in parsed.select("page_id", F.size("nodes").alias("n"), F.array_max(F.transform("nodes", lambda n: n["depth"])).alias("deep"), F.get("nodes", 0)["subtree_end"].alias("end")).collect()}
    assert [(r["n"], r["deep"], r["end"]) for r in (got[0], got[1])] == [(110_002, 100_002, 110_002), (3_002, 3_001, 3_002)]
    nodes = ladder.staged_nodes(parsed)
    assert nodes.where("size(attrs) = 0 OR tag <> 'div'").count() == 110_002 + 2 + 3
    cards = nodes.where("tag = 'div'")
    looks = {r["page_id"]: r["count"] for r in s.looks_like_card(nodes, cards, parsed).groupBy("page_id").count().collect()}
    assert looks == {0: 100_000, 1: 3_000}
    (linked,) = s.extract_linked_images(nodes.where("page_id = 0"), parsed).select("image_url").collect()
    assert linked["image_url"].endswith("/i.png")
    fields = s.card_fields(cards.where("page_id = 1").select("page_id", "node_id", "subtree_end", "piece_start", "piece_count"), nodes, parsed)
    assert fields.where("title = 'Thing' AND image_url IS NOT NULL").count() == 3_000
    assert time.time() - began < 90


def test_merge(spark):
    schema = "page_id long, rung int, pos array<bigint>, title string, product_url string, price double, in_stock boolean"
    rows = [(0, 1, [1], None, "u", 0.0, False), (0, 1, [2], "A", "u", 5.0, True), (0, 1, [3], "B", "u", 7.0, None), (1, 1, [1], "A", "u", 0.0, False), (1, 1, [2], None, "u", 0.0, None), (1, 1, [0], "x", None, 1.0, None)]
    merged = merge_by_url(spark.createDataFrame(rows, schema))
    assert [tuple(r) for r in merged.select("title", "price", "in_stock").orderBy("page_id").collect()] == [("A", 5.0, True), ("A", 0.0, False)]
    assert sorted(map(tuple, merge_by_url(merged).select("page_id", "title").collect())) == sorted(map(tuple, merged.select("page_id", "title").collect()))
    assert cap_per_page(merged, 1).count() == 2


def test_the_index_of_selectors_by_their_own_tests(spark):
    """Elements that hold parts of all groups' selectors, whole or nearly, against matches() of each selector alone."""
    rnd = random.Random(11)
    groups = [*fixed.SELECTORS.values(), ['a[href^="http"]', 'img[src$=".PNG" i]', "li.item.big[title]", 'p[title=""]', 'b[x*=""], i', "li.item, li[title]"]]
    attrs = sorted({m["attr"].lower() for g in groups for sel in g for c in sel.split(",") for m in _parts(c.strip()) if m["attr"]} | {"class", "id"})
    values = sorted({m["value"] for g in groups for sel in g for c in sel.split(",") for m in _parts(c.strip()) if m["value"]})
    tags = sorted({m["tag"].lower() for g in groups for sel in g for c in sel.split(",") for m in _parts(c.strip()) if m["tag"]} | {"b", "em"})
    value = lambda: rnd.choice(["", "products", "item big", "big\titem", "x.png", "https://a", *[rnd.choice(["", "pre ", "X"]) + rnd.choice([v, v.upper(), v[:-1]]) for v in rnd.choices(values, k=6)]])
    rows = [(i, rnd.choice(tags), {a: value() for a in rnd.sample(attrs, rnd.randrange(5))}) for i in range(1500)]
    rows += [(1500, None, {"class": "item"}), (1501, "li", None), (1502, "a", {"href": None}), (1503, "a", {"href": "https://x"}), (1504, "img", {"src": "x.png"})]
    rows += [(1505, "li", {"class": "big  item", "title": ""}), (1506, "p", {"title": ""}), (1507, "i", {}), (1508, "li", {"title": "x"})]
    df = spark.createDataFrame(rows, "id int, tag string, attrs map<string,string>")
    alone = [F.when(matches(sel), F.struct(F.lit(f).alias("field"), F.lit(r).alias("rank"))) for f, g in enumerate(groups) for r, sel in enumerate(g)]
    got = {r["id"]: [tuple(m) for m in r["marks"]] for r in df.select("id", matching_marks(groups).alias("marks")).collect()}
    want = {r["id"]: [tuple(m) for m in r["w"]] for r in df.select("id", F.array_compact(F.array(*alone)).alias("w")).collect()}
    assert got == want and {m for ms in got.values() for m in ms} >= {(len(groups) - 1, r) for r in (0, 1, 2, 3, 5)}
    assert len({m for ms in got.values() for m in ms}) > 60
    ranks = {r["id"]: r["r"] for r in df.select("id", matching_ranks(groups[1]).alias("r")).collect()}
    assert ranks == {i: [r for f, r in ms if f == 1] for i, ms in want.items()}
