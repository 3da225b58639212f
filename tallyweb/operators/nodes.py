"""Pages to element rows.

One small vectorised helper reads HTML with the standard library's tokeniser and keeps a tree; all that is decided about
elements afterwards is columns. Text is kept once a page, as an array of pieces, and elements point into it: theirs are put
together by with_text() where they are looked at, so element rows don't hold a text once for each element around it.
Elements are numbered in document order, and each knows where the numbers of those inside it end: they are
node_id + 1 to subtree_end - 1 (see containment.py). A page's rows grow with its elements, whatever their depth.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(("head", "script", "style", "template", "noscript", "title"))
#: Elements that close an open one of these kinds where they begin
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "option": ("option",),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
BLOCKS = frozenset(
    "address article aside blockquote dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr ul".split()
)
#: An open element isn't closed from beyond one of these
WALLS = frozenset(("ul", "ol", "dl", "table", "select", "html", "body", "td", "th"))

NODE = "struct<node_id:int,parent_id:int,depth:int,subtree_end:int,tag:string,attrs:map<string,string>,piece_start:int,piece_count:int,displayed:boolean,blacklisted:boolean>"
PARSED = f"page_id long, url string, pieces array<string>, nodes array<{NODE}>, scripts array<struct<node_id:int,type:string,text:string>>"


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []
        self.places: dict[str, list[int]] = {}  # by tag, where in `open` such elements are
        self.pieces: list[str] = []
        self.scripts: list[dict] = []

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            node = self.nodes[self.open.pop()]
            self.places[node["tag"]].pop()
            node["subtree_end"] = len(self.nodes)
            node["piece_count"] = len(self.pieces) - node["piece_start"]
            if node["tag"] in BLOCKS and node["displayed"]:
                self.pieces.append("\n")

    def _nearest(self, tags: Iterable[str]) -> int:
        """The depth of the nearest open element of the tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends = CLOSES.get(tag, ()) + (("p",) if tag in BLOCKS else ())
        nearest = self._nearest(ends)
        if nearest >= max(0, self._nearest(WALLS - {"td", "th"} if tag == "tr" else WALLS)):
            self._close(nearest)
        parent = self.nodes[self.open[-1]] if self.open else None
        given = {k: v if v is not None else "" for k, v in reversed(attrs)}  # the first of repeated attributes counts
        style = "".join(given.get("style", "").lower().split())
        seen = (parent is None or parent["displayed"]) and tag not in UNSEEN and "hidden" not in given and "display:none" not in style and "visibility:hidden" not in style
        if tag in BLOCKS and seen:
            self.pieces.append("\n")
        if tag == "br" and seen:
            self.pieces.append("\n")
        near = [self.nodes[i]["tag"] for i in self.open[: -fixed.SECTION_STEPS - 1 : -1]]
        lineage = [tag, *near]
        stop = next((i for i, t in enumerate(lineage) if t in ("body", "html")), len(lineage))
        node = {
            "node_id": len(self.nodes),
            "parent_id": self.open[-1] if self.open else None,
            "depth": len(self.open) + 1,
            "subtree_end": len(self.nodes) + 1,
            "tag": tag,
            "attrs": given,
            "piece_start": len(self.pieces),
            "piece_count": 0,
            "displayed": seen,
            "blacklisted": any(t in fixed.SECTIONS_REFUSED for t in lineage[:stop]),
        }
        self.nodes.append(node)
        if tag == "script":
            self.scripts.append({"node_id": node["node_id"], "type": given.get("type", ""), "text": ""})
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node["node_id"])

    def handle_endtag(self, tag: str) -> None:
        nearest = self._nearest([tag])
        if nearest >= 0:
            self._close(nearest)

    def parse_html_declaration(self, i: int) -> int:
        try:
            return super().parse_html_declaration(i)
        except AssertionError:  # the tokeniser gives up on unknown marked sections; they are comments to a browser
            return self.parse_bogus_comment(i)

    def handle_data(self, data: str) -> None:
        if not self.open:
            return
        above = self.nodes[self.open[-1]]
        if above["tag"] == "script":
            self.scripts[-1]["text"] += data
        elif above["displayed"]:
            self.pieces.append(data)

    def done(self) -> dict:
        self.close()
        self._close(0)
        return {"pieces": self.pieces, "nodes": self.nodes, "scripts": self.scripts}


def _parsed(html: str | None) -> dict:
    tree = _Tree()
    tree.feed(html or "")
    return tree.done()


def parse_nodes(pages: DataFrame) -> DataFrame:
    """(page_id, url, pieces, nodes, scripts) of pages (page_id, url, html).

    Void elements have no content; p, li, dt, dd, option and table cells may be left open, and what is open at the end is
    closed there. `depth` counts from 1. `pieces` make up the text of displayed elements in order, and an element has `piece_count` of them from
    `piece_start` on; scripts are apart.
    An element isn't displayed if it or one above is hidden by attribute or inline style, or is of the head or a script.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                yield pd.DataFrame([{"page_id": i, "url": u, **_parsed(h)} for i, u, h in zip(part["page_id"], part["url"], part["html"], strict=True)])

    return pages.select("page_id", "url", "html").mapInPandas(parse, PARSED)


def node_rows(parsed: DataFrame, keep=None) -> DataFrame:
    """One row for each element; `keep` is a test on an element (a struct), made before the explosion."""
    nodes = F.col("nodes") if keep is None else F.filter("nodes", keep)
    return parsed.select("page_id", F.explode(nodes).alias("n")).select("page_id", "n.*")


def page_text() -> Column:
    """The text of a parsed page."""
    return F.array_join("pieces", "")


def text_of_element() -> Column:
    """The text of an element, of a row that has its page's pieces, too."""
    return F.array_join(F.slice("pieces", F.col("piece_start") + 1, F.col("piece_count")), "")


def with_text(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """`rows` (page_id, piece_start, piece_count and others) of elements, and their `text`.

    To be called on what is looked at only. Each text is read from its own place on, so the work is that of its length.
    Neither side is broadcast: pieces and elements are many times as large as the compressed file that Spark knows of.
    """
    rows = rows.join(parsed.select("page_id", "pieces").hint("merge"), "page_id")
    return rows.withColumn("text", text_of_element()).drop("pieces")
