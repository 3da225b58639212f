"""Text to values: columns in, columns out."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

#: White space as Unicode has it; Java's \s is ASCII only.
BLANK = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"


def contains_any(c: Column, words: list[str]) -> Column:
    return c.rlike("|".join(_quoted(w) for w in words))


def _quoted(word: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", word)


def let(c: Column, of: Callable[[Column], Column]) -> Column:
    """of(c), with c once in the plan: the optimiser copies what a column refers to, and such copies multiply."""
    return F.get(F.transform(F.array(c), lambda x: of(x)), 0)


def first_full(*values: Column) -> Column:
    """The first value that is neither null nor empty. Each value stands in the plan once, however deep these nest."""
    return F.get(F.filter(F.array(*values), lambda x: x != ""), 0)


def or_null(c: Column) -> Column:
    """Null for the empty string."""
    return first_full(c)


def clean_text(c: Column) -> Column:
    """White space collapsed to single spaces and trimmed; null if nothing is left."""
    return or_null(F.trim(F.regexp_replace(c, BLANK + "+", " ")))


def detect_currency(c: Column) -> Column:
    return let(F.lower(c), lambda low: F.coalesce(*[F.when(contains_any(low, words), F.lit(code)) for code, words in fixed.CURRENCIES]))


def parse_number(c: Column) -> Column:
    """The first run of digits, commas and points, without commas; null if that is no number."""
    return F.replace(F.regexp_extract(c, r"[0-9,.]+", 0), F.lit(",")).try_cast("double")


def parse_price(c: Column) -> Column:
    """struct(price, currency)"""
    return let(c, lambda x: F.struct(parse_number(x).alias("price"), detect_currency(x).alias("currency")))


def parse_int(c: Column) -> Column:
    return F.regexp_extract(c, r"[0-9]+", 0).try_cast("bigint")


def parse_float(c: Column) -> Column:
    return F.regexp_extract(c, r"[0-9.]+", 0).try_cast("double")


def infer_in_stock(c: Column) -> Column:
    """What is in stock is tested first, so that "unavailable" counts as available."""
    return let(F.lower(c), lambda low: F.when(contains_any(low, fixed.IN_STOCK), True).when(contains_any(low, fixed.OUT_OF_STOCK), False))


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def extract_price_text(c: Column) -> Column:
    """The first currency marker followed by a number. A marker of letters needs a blank behind it, but for rs."""
    spaced = [m for m in fixed.PRICE_MARKERS if m.isalpha() and m != "rs"]
    signs = [_quoted(m) for m in fixed.PRICE_MARKERS if not m.isalpha() and m != "rs."]
    pattern = rf"(?i)(?:rs\.?|(?:{'|'.join(spaced)}){BLANK}|{'|'.join(signs)}){BLANK}*[0-9,.]+"
    return or_null(F.regexp_extract(c, pattern, 0))


def looks_like_phone_or_nav(c: Column) -> Column:
    return let(F.lower(c), lambda low: F.coalesce(low.rlike(r"\b\d{8,}\b") | contains_any(low, fixed.NAV_WORDS), F.lit(False)))


def page_says_no_results(text: Column) -> Column:
    return F.coalesce(contains_any(F.lower(text), fixed.NO_RESULTS_PHRASES), F.lit(False))
