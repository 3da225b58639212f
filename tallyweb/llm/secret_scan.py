"""Secret scans: fixed patterns, and strings that a Markov model of random characters explains better than one of
ordinary identifiers. DataFrame functions only; the models' counts are made by Spark from labelled samples.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .columns import free_prefix, scan, starts_of

# Fixed patterns of the base kinds, in their order
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # at least 20 characters; a shorter run holds no longer one
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

#: Strings judged by the models, whole and by their pieces between `/`: runs so long that their sum can reach the least.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
GROUPS = [*LOWER, UPPER, DIGITS, "_-", "+/="]  # classes of characters; others are of the class beyond
CLASSES = len(GROUPS) + 1
CODES = 128  # of characters; CODES itself stands for what is before the first

SAMPLE_DOCS = 2000  # texts that give ordinary identifiers at most
SAMPLE_RANDOM = 20_000  # random strings
FALSE_SHARE = 1e-4  # of held-back ordinary strings that the limits let pass at most
PRIOR = 10.0  # least sum of a random string: a key is taken to be e^-10 as frequent as an ordinary string


@dataclass(frozen=True)
class Model:
    """ratios[a * CLASSES + b]: log P(b after a | random) - log P(b after a | ordinary). least: sum from which on a string
    counts as random, if the mean of a character is at least `mean` as well."""

    ratios: tuple[float, ...]
    least: float = PRIOR
    mean: float = 0.0


def _class(code: int) -> int:
    return next((i for i, g in enumerate(GROUPS) if chr(code) in g), CLASSES - 1)


def _numbers(values: list[float]) -> Column:
    """A constant array, written as one text: thousands of literals are slow to plan."""
    return F.split(F.lit(",".join(f"{v:.4f}" for v in values)), ",").cast("array<double>")


def _score(token: Column, model: Model) -> Column:
    """Log-likelihood ratio of a string: the sum over its pairs of neighbours. Linear in its length."""
    of = [_class(c) for c in range(CODES)]
    pairs = _numbers([model.ratios[of[a] * CLASSES + of[b]] for a in range(CODES) for b in range(CODES)] + [0.0] * CODES)

    def step(acc: Column, c: Column) -> Column:
        code = F.least(F.ascii(c), F.lit(CODES - 1))
        return F.struct(code.alias("code"), (acc["total"] + F.get(pairs, acc["code"] * CODES + code)).alias("total"))

    return F.aggregate(F.split(token, ""), F.struct(F.lit(CODES).alias("code"), F.lit(0.0).alias("total")), step, lambda acc: acc["total"])


def is_random(token: Column, model: Model) -> Column:
    long_enough = F.length(token) >= _least_length(model)
    return long_enough & let(_score(token, model), lambda t: (t >= model.least) & (t >= model.mean * F.length(token)))


def _least_length(model: Model) -> int:
    """Characters without which no string reaches the least sum."""
    return 1 + math.ceil(model.least / max(model.ratios)) if max(model.ratios) > 0 else 1 << 30


def random_samples(spark: SparkSession, n: int = SAMPLE_RANDOM) -> DataFrame:
    """Strings as random as those of keys: base64, hex, and upper case with digits; cut to 20 to 60 characters."""
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    text = F.when(F.col("id") % 3 == 0, digest).when(F.col("id") % 3 == 1, F.base64(F.unhex(digest))).otherwise(F.upper(F.translate(F.base64(F.unhex(digest)), "+/=", "")))
    return spark.range(n).select(F.substring(text, F.lit(1), (F.lit(20) + F.col("id") % 41).cast("int")).alias("token"), F.lit(1).alias("random"))


def identifier_samples(docs: DataFrame, n_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Identifiers as people write them, of the words of at most `n_docs` whole texts (those of the least hashes): words
    joined by `_` or `-`, in camel case, with numbers at the end."""
    texts = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("h"), "text")
    # the bound is found among hashes, so that no task gathers texts that don't belong to the sample
    bound = texts.select("h").distinct().orderBy("h").limit(n_docs).agg(F.max("h")).first()[0]
    texts = texts.where(F.col("h") <= F.lit(bound).cast("long")).groupBy("h").agg(F.min("text").alias("text"))
    words = texts.select(F.transform(F.regexp_extract_all("text", F.lit(r"[A-Za-z]{3,}"), F.lit(0)), F.lower).alias("w")).where(F.size("w") > 3)

    def made(i: Column) -> Column:
        word = lambda j: F.get("w", i + j)
        number = (F.abs(F.hash(word(0))) % 100).cast("string")
        ways = [
            F.concat_ws("_", word(0), word(1), word(2), number),
            F.concat(word(0), F.initcap(word(1)), F.initcap(word(2)), number),
            F.upper(F.concat_ws("_", word(0), word(1), number)),
            F.concat_ws("-", word(0), word(1), number, word(2)),
            F.concat(word(0), word(1), word(2)),
        ]
        way = F.pmod(F.hash(word(1)), F.lit(len(ways)))
        return F.coalesce(*[F.when(way == k, m) for k, m in enumerate(ways)])

    tokens = F.transform(F.sequence(F.lit(0), F.size("w") - 4, F.lit(3)), made)
    return words.select(F.explode(tokens).alias("token"), F.lit(0).alias("random"))


def train(samples: DataFrame, smoothing: float = 0.5) -> Model:
    """Models of labelled samples (token, random 0/1), fitted on four fifths of the distinct strings, and their limits on the
    rest: `least` is PRIOR or the sum, `mean` the mean, that all but FALSE_SHARE of held-back ordinary strings stay below.

    What comes to the driver is bounded by the number of class pairs. Null and one-character strings say nothing; without
    samples of a kind its pairs are alike.
    """
    samples = samples.where(F.length("token") > 1).distinct().withColumn("back", F.pmod(F.xxhash64("token"), F.lit(5)) == 0)
    chars = F.split("token", "")
    classes = F.transform(chars, lambda c: F.get(F.lit([_class(c) for c in range(CODES)]), F.least(F.ascii(c), F.lit(CODES - 1))))
    pairs = samples.where("NOT back").select("random", classes.alias("c"))
    pairs = pairs.select("random", F.explode(F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: a * CLASSES + b)).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}

    def logs(kind: int) -> list[float]:
        out = []
        for a in range(CLASSES):
            row = [counts.get((kind, a * CLASSES + b), 0) + smoothing for b in range(CLASSES)]
            out += [math.log(x / sum(row)) for x in row]
        return out

    model = Model(tuple(round(r - o, 4) for r, o in zip(logs(1), logs(0), strict=True)))
    ordinary = samples.where("back AND random = 0").select(_score(F.col("token"), model).alias("t"), F.length("token").alias("n"))
    limits = ordinary.agg(F.percentile("t", F.lit(1 - FALSE_SHARE)).alias("least"), F.percentile(F.col("t") / F.col("n"), F.lit(1 - FALSE_SHARE)).alias("mean")).first()
    return replace(model, least=max(PRIOR, limits["least"] or 0.0), mean=max(0.0, limits["mean"] or 0.0))


SPAN = "struct<start:int,k:int,end:int>"


def _none() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def _span(start: Column, kind: str, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("k"), end.alias("end"))


def _matches(text: Column, pattern: str) -> Column:
    """(text, start) of the leftmost non-overlapping matches. A match starts after what is between the matches, and the
    matches, before it."""

    def placed(matches: Column, gaps: Column) -> Column:
        starts = starts_of(F.zip_with(matches, gaps, lambda m, g: F.length(m) + g))
        return F.zip_with(F.zip_with(starts, gaps, lambda s, g: s + g), matches, lambda s, m: F.struct(m.alias("text"), s.alias("start")))

    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: let(F.slice(gaps, F.lit(1), F.size(m)), lambda g: placed(m, g)))


def _base(text: Column, kind: str, pattern: str, cheap: Column, passes) -> Column:
    found = F.filter(_matches(text, pattern), lambda m: passes(m["text"]))
    spans = F.transform(found, lambda m: _span(m["start"], kind, m["start"] + F.length(m["text"])))
    return F.when(cheap & text.rlike(pattern), spans).otherwise(_none())


def _outside(spans: Column, base: Column) -> Column:
    """The parts of `spans`, which are apart, that no span of `base` covers: a sweep over where spans begin and end."""
    event = lambda at, b, s: F.struct(at.alias("at"), F.lit(b).alias("base"), F.lit(s).alias("mine"))
    events = F.concat(
        F.flatten(F.transform(base, lambda x: F.array(event(x["start"], 1, 0), event(x["end"], -1, 0)))),
        F.flatten(F.transform(spans, lambda x: F.array(event(x["start"], 0, 1), event(x["end"], 0, -1)))),
    )

    def step(state: Column, e: Column) -> tuple[Column, Column]:
        part = F.when((state["mine"] > 0) & (state["base"] == 0) & (e["at"] > state["at"]), _span(state["at"], "random", e["at"]))
        return F.struct(e["at"].alias("at"), (state["base"] + e["base"]).alias("base"), (state["mine"] + e["mine"]).alias("mine")), part

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("base"), F.lit(0).alias("mine"))
    parts = F.filter(scan(F.sort_array(events), start, step, SPAN), lambda x: x.isNotNull())
    return F.when((F.size(base) > 0) & (F.size(spans) > 0), parts).otherwise(spans)


def _random_spans(text: Column, model: Model) -> Column:
    """Runs that are random, and the random pieces of others between `/`. Distinct runs are judged first, so that places are
    only worked out in texts that hold a random one."""
    pattern = CANDIDATE % _least_length(model)
    random = lambda x: is_random(x, model)
    any_random = F.exists(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), lambda m: random(m) | (m.contains("/") & F.exists(F.split(m, "/", -1), random)))

    def pieces(m: Column) -> Column:
        of = lambda parts: F.zip_with(parts, starts_of(F.transform(parts, lambda x: F.length(x) + 1)), lambda x, at: F.struct(x.alias("text"), (m["start"] + at).alias("start")))
        return F.filter(let(F.split(m["text"], "/", -1), of), lambda x: random(x["text"]))

    kept = lambda m: F.when(random(m["text"]), F.array(m)).when(m["text"].contains("/"), pieces(m)).otherwise(F.array().cast("array<struct<text:string,start:int>>"))
    spans = F.transform(F.flatten(F.transform(_matches(text, pattern), kept)), lambda m: _span(m["start"], "random", m["start"] + F.length(m["text"])))
    return F.when(any_random, spans).otherwise(_none())


def find_secrets(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `spans` added: (kind, start, end) in code points, the end exclusive, by start, then kind.

    Kinds assign, access and hex are those of the fixed patterns; `random` are further strings that the model takes for
    random, of any length: runs of letters, digits and `+/_-`, or else their pieces between `/`, without the parts that
    the others cover. Null texts are empty; rows that repeat are scanned each by itself; no rows give none. The work is
    about linear in a text's length and its number of spans. A column `spans` of the input is replaced; others pass
    through, whatever their names.
    """
    docs = docs.drop("spans")
    p, text = free_prefix(docs), F.coalesce("text", F.lit(""))
    # the pattern's own greedy match decides what it consumes, so a value too short is dropped only afterwards
    assign = _base(text, "assign", ASSIGN, text.contains("=") | text.contains(":"), lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)
    access = _base(text, "access", ACCESS, text.contains("AKIA"), lambda m: F.lit(True))
    hexes = _base(text, "hex", HEX, F.lit(True), lambda m: F.lit(True))
    out = docs.select("*", F.sort_array(F.concat(assign, access, hexes)).alias(p + "base"), _random_spans(text, model).alias(p + "more"))
    ordered = F.sort_array(F.concat(p + "base", _outside(F.col(p + "more"), F.col(p + "base"))))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(ordered, lambda s: F.struct(F.get(kinds, s["k"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select(*docs.columns, spans.alias("spans"))


def secrets_digest(docs: DataFrame, model: Model) -> DataFrame:
    """Counts and written spans of find_secrets(), which says how odd rows are taken; one row for each row of `docs`."""
    found = find_secrets(docs.select("doc_id", "text"), model)
    written = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
