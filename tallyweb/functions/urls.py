"""Urls: parts, resolution of references, and tests for product links. Columns only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import contains_any, let

#: RFC 3986, appendix B: scheme, network location, path, query, fragment
_PARTS = r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
_SCHEME, _HOST, _PATH, _QUERY, _FRAGMENT = range(1, 6)


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _PARTS, k)


def platform(url: Column) -> Column:
    """The network location, with port and user."""
    return _part(url, _HOST)


def is_blacklisted_link(url: Column) -> Column:
    schemes = "|".join(fixed.LINK_SCHEMES_REFUSED)
    return let(
        F.lower(F.coalesce(url, F.lit(""))),
        lambda low: (low == "") | low.rlike(rf"\A(?:{schemes})") | contains_any(low, fixed.LINK_KEYWORDS_REFUSED),
    )


def is_product_like_path(url: Column) -> Column:
    def parts(low: Column) -> Column:
        path = F.regexp_replace(_part(low, _PATH), r";[^/]*\z", "")
        return F.struct(path.alias("path"), F.concat(path, F.lit("?"), _part(low, _QUERY), F.lit("#"), _part(low, _FRAGMENT)).alias("all"))

    def answer(x: Column) -> Column:
        path = x["path"]
        slashes = F.length(path) - F.length(F.replace(path, F.lit("/")))
        return (
            F.when(path.isin(fixed.HOME_PATHS), False)
            .when(contains_any(x["all"], fixed.PRODUCT_KEYWORDS), True)
            .when(contains_any(x["all"], fixed.PATH_KEYWORDS_REFUSED), False)
            .otherwise(
                path.rlike(r"\.html?\z") | ((slashes >= 2) & (F.length(path) > 3)) | (path.contains("-") & (F.length(F.replace(path, F.lit("-"))) > 6))
            )
        )

    return F.coalesce(let(let(F.lower(url), parts), answer), F.lit(False))


def is_potential_product_href(url: Column) -> Column:
    return ~is_blacklisted_link(url) & is_product_like_path(url)


def _without_dots(parts: Column) -> Column:
    """Path segments with `.` and `..` taken out; a path that ends in one ends in a slash."""
    step = lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.array_append(acc, s))
    resolved = F.aggregate(parts, F.expr("cast(array() as array<string>)"), step)
    return F.concat(resolved, F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.expr("cast(array() as array<string>)")))


def _merged_path(path: Column, base_path: Column) -> Column:
    """A path that isn't empty, placed beside the base's last segment unless it begins at the root."""

    def beside(above: Column) -> Column:
        kept = F.slice(above, F.lit(1), F.size(above) - F.when(F.element_at(above, -1) != "", 1).otherwise(0))
        return F.concat(kept, F.split(path, "/"))

    def tight(all_: Column) -> Column:
        return F.filter(all_, lambda s, i: (s != "") | (i == 0) | (i == F.size(all_) - 1))

    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(let(let(F.split(base_path, "/"), beside), tight))
    return let(F.array_join(let(segments, _without_dots), "/"), lambda p: F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)))


def to_absolute(base: Column, href: Column) -> Column:
    """The reference `href` resolved against `base` (RFC 3986, 5.2); null if empty. Another scheme's url stays as it is."""

    def parts(url: Column) -> Column:
        names = ("scheme", "host", "path", "query", "fragment")
        return F.struct(*[_part(url, k + 1).alias(n) for k, n in enumerate(names)], url.rlike(r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]").alias("has_host"))

    def resolved(x: Column) -> Column:
        r, b, href = x["r"], x["b"], x["href"]
        scheme = F.lower(b["scheme"])
        root = F.concat(scheme, F.lit("://"), b["host"])
        query = F.when(r["query"] != "", F.concat(F.lit("?"), r["query"])).otherwise("")
        own_query = F.when((r["query"] == "") & (b["query"] != ""), F.concat(F.lit("?"), b["query"])).otherwise(query)
        fragment = F.when(r["fragment"] != "", F.concat(F.lit("#"), r["fragment"])).otherwise("")
        return (
            F.when(F.coalesce(href, F.lit("")) == "", F.lit(None))
            .when((r["scheme"] != "") & (F.lower(r["scheme"]) != scheme), href)
            .when(r["has_host"], F.concat(scheme, F.lit("://"), r["host"], r["path"], query, fragment))
            .when(r["path"] == "", F.concat(root, b["path"], own_query, fragment))
            .otherwise(F.concat(root, _merged_path(r["path"], b["path"]), query, fragment))
        )

    ref = F.regexp_replace(F.regexp_replace(href, r"\A[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return let(F.struct(let(ref, parts).alias("r"), let(base, parts).alias("b"), href.alias("href")), resolved)
