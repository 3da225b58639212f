"""Product-like objects of JSON scripts, in document order.

A vectorised helper parses and walks, neither by recursion; it gives the raw scalars of each object, and columns do the
rest. What an object's fields may hold is declared in tables; with `strict` an object with a value of another type is dropped with all beneath
it, else such values are written as text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed

RAW = "title string, url string, image string, price string, currency string, rating string, review_count string, availability string, brand string, sku string, description string"
_NAMES = [f.split()[0] for f in RAW.split(", ")]
SCHEMA = f"page_id long, seq long, {RAW}"

#: Names under which generic objects keep a field, the first with a value counts
ALIASES = {
    "title": ["name", "title", "productName", "product_name", "label"],
    "url": ["url", "link", "productUrl", "productURL", "href", "canonicalUrl"],
    "image": ["image", "imageUrl", "imageURL", "thumbnail", "thumbnailUrl", "mediaUrl", "picture"],
    "price": ["price", "salePrice", "offerPrice", "priceValue", "price_amount", "priceWithTax"],
    "currency": ["currency", "currencyCode", "priceCurrency"],
    "brand": ["brand", "manufacturer", "maker"],
    "sku": ["sku", "id", "productId", "product_id", "itemId"],
    "description": ["description", "shortDescription", "summary"],
    "rating": ["rating", "ratingValue", "averageRating", "reviewRating"],
    "review_count": ["reviewCount", "reviewsCount", "numberOfReviews", "ratingCount"],
    "availability": ["availability", "stockStatus", "availabilityStatus"],
}
#: Where an object in place of a scalar keeps it
WITHIN = {"price": ["value", "amount", "price"], "url": ["url", "href"], "image": ["url", "src"]}
#: Fields that must be text; numbers of the others are written as such, and images of another type count as none
TEXTUAL = ("title", "url", "currency", "availability", "brand", "sku", "description")


class Unfit(Exception):
    """An object that holds something else than its fields may."""


_CLOSING = {"{": "}", "[": "]"}
_OPENING = re.compile(r"[{\[]")
_BLANK = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"true|false|null|NaN|-?Infinity|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?")


def pieces(text: str) -> Iterator[str]:
    """Disjoint pieces from an opening bracket to the next closing one of its kind, from the left; what is never closed
    is passed over. One pass: once a closing bracket isn't found, it isn't looked for again."""
    at, missing = 0, set()
    while m := _OPENING.search(text, at):
        at = m.end()
        if m[0] in missing:
            continue
        end = text.find(_CLOSING[m[0]], at)
        if end < 0:
            missing.add(m[0])
            if len(missing) == len(_CLOSING):
                return
        else:
            at = end + 1
            yield text[m.start() : at]


def deep_loads(text: str) -> Any:
    """json.loads() for any depth: open arrays and objects are on a list of its own."""
    scan, top = json.decoder.scanstring, []
    open_ones, at = [(top, None)], 0  # containers, and the key that an object's next value is for

    def skip(i: int) -> int:
        return _BLANK.match(text, i).end()

    def key(i: int) -> tuple[str, int]:
        if text[i : i + 1] != '"':
            raise ValueError("no key")
        name, i = scan(text, i + 1, True)
        i = skip(i)
        if text[i : i + 1] != ":":
            raise ValueError("no colon")
        return name, skip(i + 1)

    def put(value: Any) -> None:
        into, name = open_ones[-1]
        if name is None:
            into.append(value)
        else:
            into[name] = value

    at = skip(0)
    while True:  # a value begins at `at`
        c = text[at : at + 1]
        if c in ("[", "{"):
            value = [] if c == "[" else {}
            put(value)
            at = skip(at + 1)
            if text[at : at + 1] == _CLOSING[c]:
                at = skip(at + 1)
            elif c == "[":
                open_ones.append((value, None))
                continue
            else:
                name, at = key(at)
                open_ones.append((value, name))
                continue
        elif c == '"':
            value, at = scan(text, at + 1, True)
            put(value)
            at = skip(at)
        elif m := _SCALAR.match(text, at):
            put(json.loads(m[0]))
            at = skip(m.end())
        else:
            raise ValueError("no value")
        while len(open_ones) > 1:  # after a value: the next one, or ends of containers
            into, _ = open_ones[-1]
            c = text[at : at + 1]
            if c == ",":
                at = skip(at + 1)
                if isinstance(into, dict):
                    name, at = key(at)
                    open_ones[-1] = (into, name)
                break
            if c != ("}" if isinstance(into, dict) else "]"):
                raise ValueError("not closed")
            open_ones.pop()
            at = skip(at + 1)
        else:
            if at < len(text):
                raise ValueError("more than a value")
            return top[0]


def loads(text: str) -> Any:
    """ValueError if the text isn't JSON; any depth."""
    try:
        return json.loads(text)
    except RecursionError:
        return deep_loads(text)


def blobs(text: str) -> list[Any]:
    """The whole text as JSON, else each of its pieces() that is. Work is linear in the text's length."""
    try:
        return [loads(text)]
    except ValueError:
        out = []
        for piece in pieces(text):
            try:
                out.append(loads(piece))
            except ValueError:
                pass
        return out


def _told(value: Any) -> str:
    """str(), of values that aren't too deep to be written."""
    try:
        return str(value)
    except (RecursionError, ValueError) as e:  # ValueError: an integer of very many digits
        raise Unfit from e


def _truth(values: Iterator[Any]) -> Any:
    """The first value that isn't empty, else the last."""
    value = None
    for value in values:
        if value:
            break
    return value


def _scalars(fields: dict[str, Any], strict: bool) -> dict[str, str | None]:
    out = {}
    for name in _NAMES:
        value = fields.get(name)
        if name == "image" and not isinstance(value, str):
            value = None
        if name == "url" and not value:
            value = None
        if value is None:
            out[name] = None
        elif isinstance(value, str):
            out[name] = value
        elif name in TEXTUAL and strict:
            raise Unfit(name)
        elif name in ("rating", "review_count") and not value:
            out[name] = None  # zero is no value
        else:
            out[name] = _told(value)
    return out


def _object(value: Any) -> dict:
    """An empty value is an empty object; another that is none is unfit."""
    if not value:
        return {}
    if not isinstance(value, dict):
        raise Unfit
    return value


def ld_fields(d: dict) -> dict[str, Any]:
    """Fields of a JSON-LD product; some are looked for in `item` too."""

    def own_or_item(key: str) -> Any:
        return d.get(key) or _object(d.get("item")).get(key)

    first = lambda v: v[0] if isinstance(v, list) and v else v
    inner = lambda v: v if isinstance(v, dict) else {}
    offer, rating, brand = inner(first(d.get("offers"))), inner(d.get("aggregateRating")), first(d.get("brand"))
    if isinstance(brand, dict):
        brand = _truth(brand.get(k) for k in ("name", "brand"))
    return {
        **{k: own_or_item(k) for k in ("url", "sku", "description")},
        "title": own_or_item("name"),
        "image": first(d.get("image")),
        "price": offer.get("price"),
        "currency": offer.get("priceCurrency") or None,
        "availability": offer.get("availability"),
        "rating": rating.get("ratingValue"),
        "review_count": rating.get("reviewCount"),
        "brand": brand,
    }


def generic_fields(d: dict) -> dict[str, Any] | None:
    """Fields of any object by their aliases, or None without title and url."""
    out = {}
    for name, aliases in ALIASES.items():
        value = next((d[a] for a in aliases if a in d and d[a] not in (None, "")), None)
        if isinstance(value, list):
            if not value:
                raise Unfit(name)
            value = value[0]
        if isinstance(value, dict) and name in WITHIN:
            value = _truth(value.get(k) for k in WITHIN[name])
        out[name] = value
    out["currency"] = out["currency"] or None
    return out


def _walk_ld(value: Any, strict: bool) -> Iterator[dict]:
    todo = [value]  # the last is the next one
    while todo:
        value = todo.pop()
        if isinstance(value, list):
            todo += reversed(value)
        elif isinstance(value, dict):
            kind = value.get("@type") or value.get("type") or ""
            if strict and not isinstance(kind, str):
                continue
            try:
                if _told(kind).lower() in ("product", "listitem") or "Product" in _told(value.get("@type")):
                    yield _scalars(ld_fields(value), strict)
            except Unfit:
                continue
            todo += [value[key] for key in ("mainEntity", "itemListElement") if key in value]


def _walk_generic(value: Any, strict: bool) -> Iterator[dict]:
    todo = [(value, 0)]
    while todo:
        value, depth = todo.pop()
        if depth > fixed.GENERIC_DEPTH:
            continue
        if isinstance(value, list):
            todo += [(member, depth + 1) for member in reversed(value)]
        elif isinstance(value, dict):
            try:
                found = _scalars(generic_fields(value), strict)
            except Unfit:
                continue
            if (found["title"] or "").strip() or found["url"]:
                yield found
            inner = [v for k, v in value.items() if isinstance(v, (list, dict)) and (depth <= fixed.SHALLOW_DEPTH or any(x in k.lower() for x in fixed.PRODUCT_LIKE_KEYS))]
            todo += [(v, depth + 1) for v in reversed(inner)]


WALKS = {"ld": _walk_ld, "generic": _walk_generic}


def walk_json(scripts: DataFrame, kind: str, strict: bool = True) -> DataFrame:
    """(page_id, seq, raw fields) of scripts (page_id, texts): texts is the page's list, in document order."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_id, texts in zip(batch["page_id"], batch["texts"], strict=True):
                found = (f for text in texts for blob in blobs(text) for f in WALKS[kind](blob, strict))
                rows += [{"page_id": page_id, "seq": i, **f} for i, f in enumerate(found)]
            yield pd.DataFrame(rows, columns=["page_id", "seq", *_NAMES])

    return scripts.select("page_id", "texts").mapInPandas(walk, SCHEMA)
