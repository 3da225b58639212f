"""CSS compound selectors as columns over (tag, attrs).

One selector is a test made of columns (matches). Many are an index (matching_marks): a literal map from a tag, an attribute's
name, or both, to the compounds that need it, with their tests as data; an element looks up what it has, and is tested
against these compounds only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import clean_text, contains_any, or_null
from .containment import following
from .nodes import with_text

_TOKEN = re.compile(
    r"""(?P<tag>[A-Za-z][\w-]*)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[*^$]?=)\s*"(?P<value>[^"]*)"\s*(?P<fold>i)?\s*)?\]"""
)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _parts(compound: str) -> Iterator[re.Match]:
    at = 0
    while at < len(compound):
        m = _TOKEN.match(compound, at)
        if not m:
            raise ValueError(f"selector not understood: {compound!r}")
        at = m.end()
        yield m


def _tests(compound: str) -> str:
    """SQL over `tag` and `attrs`: as text it is read once, where columns would take a call for each of many parts."""
    out = []
    for m in _parts(compound):
        if m["tag"]:
            out.append(f"tag = {_text(m['tag'].lower())}")
        elif m["cls"]:
            out.append(f"array_contains(split(attrs['class'], '[ \\t-\\r]+'), {_text(m['cls'])})")
        else:
            value, wanted = f"attrs[{_text(m['attr'].lower())}]", m["value"]
            if m["fold"]:
                value, wanted = f"lower({value})", wanted.lower()
            if m["op"] is None:
                out.append(f"{value} IS NOT NULL")
            elif m["op"] == "=":
                out.append(f"{value} = {_text(wanted)}")
            else:
                test = {"*=": "contains", "^=": "startswith", "$=": "endswith"}[m["op"]]
                out.append(f"{test}({value}, {_text(wanted)})" if wanted else "false")
    return f"coalesce({' AND '.join(out)}, false)"


def _any_of(selector: str) -> str:
    return "(" + " OR ".join(_tests(compound.strip()) for compound in selector.split(",")) + ")"


def matches(selector: str) -> Column:
    """Whether an element matches a comma list of compounds (tag, .class, [attr], [attr="v"], [attr*="v" i])."""
    return F.expr(_any_of(selector))


def _index(groups: list[list[str]]) -> str:
    """SQL of a constant map: key, and of each compound that needs it, field, rank and tests (name, op, value). Keys are
    `tag` of compounds without other tests, `[name` or `tag[name`. A compound stands under its first attribute other than
    class, if it has one, as nearly all elements have a class."""
    found: dict[str, list[str]] = {}
    for field, group in enumerate(groups):
        for rank, selector in enumerate(group):
            for compound in selector.split(","):
                tag, tests = "", []
                for m in _parts(compound.strip()):
                    if m["tag"]:
                        tag = m["tag"].lower()
                    elif m["cls"]:
                        tests.append(("class", "word", m["cls"]))
                    else:
                        value = m["value"] or ""
                        tests.append((m["attr"].lower(), (m["op"] or "") + ("i" if m["fold"] else ""), value.lower() if m["fold"] else value))
                first = min(tests, key=lambda t: t[0] == "class", default=None)
                key = f"{tag}[{first[0]}" if first else tag
                said = ", ".join(f"named_struct('name', {_text(n)}, 'op', {_text(o)}, 'value', {_text(v)})" for n, o, v in tests)
                said = f"array({said})" if tests else "CAST(array() AS ARRAY<STRUCT<name: STRING, op: STRING, value: STRING>>)"
                found.setdefault(key, []).append(f"named_struct('field', {field}, 'rank', {rank}, 'tests', {said})")
    return f"map({', '.join(f'{_text(k)}, array({", ".join(v)})' for k, v in found.items())})"


def matching_marks(groups: list[list[str]]) -> Column:
    """(field, rank) of all selectors that an element matches: the group's place in `groups`, the selector's in its group."""
    keys = "concat(array(tag), flatten(transform(coalesce(map_keys(attrs), array()), a -> array(concat('[', a), concat(tag, '[', a)))))"
    value = "if(endswith(t.op, 'i'), lower(attrs[t.name]), attrs[t.name])"
    test = f"""CASE trim(TRAILING 'i' FROM t.op) WHEN '' THEN {value} IS NOT NULL WHEN '=' THEN {value} = t.value
      WHEN 'word' THEN array_contains(split({value}, '[ \\t-\\r]+'), t.value) WHEN '*=' THEN t.value <> '' AND contains({value}, t.value)
      WHEN '^=' THEN t.value <> '' AND startswith({value}, t.value) ELSE t.value <> '' AND endswith({value}, t.value) END"""
    known = f"filter(transform({keys}, k -> try_element_at({_index(groups)}, k)), x -> x IS NOT NULL)"
    fits = f"filter(flatten({known}), s -> forall(s.tests, t -> coalesce({test}, false)))"
    return F.expr(f"array_sort(array_distinct(transform({fits}, s -> named_struct('field', s.field, 'rank', s.rank))))")


def matching_ranks(group: list[str]) -> Column:
    """Places in `group` of the selectors that an element matches."""
    return matching_marks([group])["rank"]


def first_nonempty_selector(nodes: DataFrame, group: list[str]) -> DataFrame:
    """(page_id, node_id, subtree_end, rank): of each page, the displayed elements that match the first selector which any matches."""
    hits = nodes.where("displayed").select("page_id", "node_id", "subtree_end", F.explode(matching_ranks(group)).alias("rank"))
    best = hits.groupBy("page_id").agg(F.min("rank").alias("rank"))
    return hits.join(best, ["page_id", "rank"]).select("page_id", "node_id", "subtree_end", "rank")


def element_text(text: Column) -> Column:
    return clean_text(text)


def attr(name: str) -> Column:
    """An attribute of an element; null if it is empty."""
    return or_null(F.col("attrs")[name])


IMAGES = "img[src], img[data-src], img[data-original]"


def looks_like_card(nodes: DataFrame, cards: DataFrame, parsed: DataFrame) -> DataFrame:
    """(page_id, node_id) of `cards` with a link inside, and an image inside or a price-like text. Texts are read of those
    without an image only."""
    found = nodes.select("page_id", "node_id", "subtree_end", matches("a[href]").alias("link"), matches(IMAGES).alias("image"))
    within = lambda test: F.coalesce(following(F.when(F.col(test), F.col("node_id"))) < F.col("subtree_end"), F.lit(False)).alias(test)
    found = found.select("page_id", "node_id", within("link"), within("image")).where("link")
    priced = F.coalesce(contains_any(F.lower("text"), fixed.PRICE_TOKENS), F.lit(False))
    linked = cards.select("page_id", "node_id", "piece_start", "piece_count").join(found, ["page_id", "node_id"])
    told = with_text(linked.where("NOT image"), parsed).where(priced)
    return linked.where("image").select("page_id", "node_id").unionByName(told.select("page_id", "node_id"))


def page_anchors(nodes: DataFrame) -> DataFrame:
    """Displayed anchors with href outside the refused sections."""
    return nodes.where(F.col("displayed") & ~F.col("blacklisted") & matches("a[href]") & attr("href").isNotNull())
