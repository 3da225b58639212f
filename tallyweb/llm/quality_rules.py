"""Quality classifier: a sparse ensemble of rules.

Boosted shallow trees on text statistics give conjunctive rules (one for each path from the root); a logistic model with a
lasso penalty weighs them; what keeps a weight is compiled to one Spark column expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import free_prefix

FIT_ROWS = 20_000  # labelled documents that a model is fitted on at most (those of the least hashes of their ids)
TREES, DEPTH, BINS, SHRINKAGE = 24, 3, 32, 0.3
LEAST_IN_LEAF = 8
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)  # tried in turn, on a fifth of the rows held back

SYMBOLS = r"[^\p{L}\p{N}\s.,;:'\"!?()-]"  # neither letters, digits, blanks nor the punctuation of prose


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def with_statistics(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """`docs` with statistics of `text` added, and their names, which no column of `docs` has."""
    p, text = free_prefix(docs), F.coalesce(F.col("text"), F.lit(""))
    counts = {"symbols": SYMBOLS, "upper": r"\p{Lu}", "digits": r"\p{Nd}", "stops": r"[.,;:]", "shouts": r"[!?]", "breaks": r"\n"}
    counted = docs.select(
        "*",
        F.length(text).alias(p + "chars"),
        F.filter(F.split(text, r"\s+"), lambda w: w != "").alias(p + "words"),
        *[F.regexp_count(text, F.lit(pattern)).alias(p + name) for name, pattern in counts.items()],
    )
    counted = counted.select("*", F.size(p + "words").alias(p + "n"), F.size(F.array_distinct(p + "words")).alias(p + "distinct"))
    c = lambda name: F.col(p + name)
    statistics = {
        "x_chars": F.log1p(c("chars")),
        "x_words": F.log1p(c("n")),
        "x_word_chars": _ratio(c("chars") - c("breaks"), c("n") + 1),
        "x_distinct": _ratio(c("distinct"), c("n")),
        "x_distinct_root": _ratio(c("distinct"), F.sqrt(c("n"))),
        "x_symbols": _ratio(c("symbols"), c("n")),
        "x_upper": _ratio(c("upper"), c("chars")),
        "x_digits": _ratio(c("digits"), c("chars")),
        "x_stops": _ratio(c("stops"), c("n")),
        "x_shouts": _ratio(c("shouts"), c("n")),
        "x_breaks": _ratio(c("breaks"), c("n")),
    }
    return counted.select(*docs.columns, *[v.cast("double").alias(p + k) for k, v in statistics.items()]), [p + k for k in statistics]


@dataclass(frozen=True)
class Rule:
    """All of (statistic, is it above, threshold) hold."""

    tests: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for j, above, at in self.tests:
            out &= (x[:, j] > at) == above
        return out

    def column(self, names: list[str]) -> Column:
        out = None
        for j, above, at in self.tests:
            test = F.col(names[j]) > at if above else F.col(names[j]) <= at
            out = test if out is None else out & test
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...] = ()

    def score(self, names: list[str]) -> Column:
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(names), rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _tree(codes: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray, depth: int, tests: tuple, rules: list, step: np.ndarray) -> None:
    """Splits `rows` where the gain is largest; adds the path of each node to `rules`, and the leaves' values to `step`."""
    g, h = gradient[rows].sum(), hessian[rows].sum()
    best = (1e-6, None, 0)
    if depth and len(rows) >= 2 * LEAST_IN_LEAF:
        for j in range(codes.shape[1]):
            c = codes[rows, j]
            n = np.cumsum(np.bincount(c, minlength=BINS + 1))[:-1]
            gl = np.cumsum(np.bincount(c, gradient[rows], BINS + 1))[:-1]
            hl = np.cumsum(np.bincount(c, hessian[rows], BINS + 1))[:-1]
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(n < LEAST_IN_LEAF) | (len(rows) - n < LEAST_IN_LEAF)] = 0
            gain = gain[: len(edges[j])]
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), j, int(gain.argmax()))
    if best[1] is None:
        step[rows] = -SHRINKAGE * g / (h + 1)
        return
    _, j, at = best
    below = codes[rows, j] <= at
    for above, part in ((False, rows[below]), (True, rows[~below])):
        path = (*tests, (j, above, float(edges[j][at])))
        rules.append(Rule(path))
        _tree(codes, edges, gradient, hessian, part, depth - 1, path, rules, step)


def _grow(x: np.ndarray, y: np.ndarray, seed: int) -> list[Rule]:
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    random, rules = np.random.default_rng(seed), []
    total = np.full(len(y), math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        step, rows = np.zeros(len(y)), np.flatnonzero(random.random(len(y)) < 0.7)
        found: list[Rule] = []
        _tree(codes, edges, p - y, p * (1 - p), rows, DEPTH, (), found, step)
        total += step
        rules += found
    return list({r.tests: r for r in rules}.values())


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 250) -> tuple[float, np.ndarray]:
    """Logistic weights by accelerated proximal gradients; the intercept isn't penalised."""
    n, m = z.shape
    y = y.astype(np.float32)
    some = z[:: max(1, n // 4000)]
    bound = np.float32(0.33 * np.linalg.norm(some.T @ some, 2) / len(some) + 0.25)
    w = at = np.zeros(m, dtype=np.float32)
    b = b_at = np.float32(math.log((y.sum() + 1) / (n - y.sum() + 1)))
    t = 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ at + b_at))) - y
        new = at - (error @ z) / n / bound
        new = np.sign(new) * np.maximum(np.abs(new) - np.float32(penalty) / bound, 0)
        b_new = b_at - error.mean() / bound
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        pull = np.float32((t - 1) / t_new)
        at, b_at = new + pull * (new - w), b_new + pull * (b_new - b)
        w, b, t = new, b_new, t_new
    return float(b), w


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> RuleModel:
    """A model of statistics and 0/1 labels. Without rows of both labels it has no rules, only the smoothed share of 1s."""
    base = RuleModel(math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if len(set(y.tolist())) < 2:
        return base
    rules = _grow(x, y, seed)
    if not rules:
        return base
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float32)
    back = np.random.default_rng(seed).random(len(y)) < 0.2

    def loss(b: float, w: np.ndarray) -> float:
        s = z[back] @ w + b
        return float(np.mean(np.logaddexp(0, s) - y[back] * s)) if back.any() else 0.0

    fits = {p: _lasso(z[~back], y[~back], p) for p in PENALTIES} if (~back).any() else {}
    losses = {p: loss(*f) for p, f in fits.items()}
    least = min(losses.values())
    penalty = next(p for p in PENALTIES if losses[p] <= least + 0.002)  # the sparsest that is about as good
    b, w = _lasso(z, y, penalty)
    return RuleModel(float(b), tuple(Rule(r.tests, float(v)) for r, v in zip(rules, w, strict=True) if abs(v) > 1e-4))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> RuleModel:
    """Fitted on at most `fit_rows` labelled documents, of those not held out. Rows without doc_id or label are left out."""
    known = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most fit_rows rows of two numbers
    stats, names = with_statistics(texts)
    rows = np.array(stats.select("quality", *names).orderBy("doc_id", "quality", *names).limit(fit_rows).collect(), dtype=np.float64)
    rows = rows.reshape(-1, 1 + len(names))
    return fit_rules(rows[:, 1:], (rows[:, 0] > 0).astype(np.float64))


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from a score of 0.5 on) added, from whole texts and nothing else.

    Null texts are empty, and are scored as such; repeated rows each by themselves. Columns of these names are replaced.
    """
    docs = docs.drop("score", "predicted")
    stats, names = with_statistics(docs)
    out = stats.select(*docs.columns, model.score(names).alias("score"))
    return out.select("*", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


def quality_digest(docs: DataFrame, model: RuleModel) -> DataFrame:
    """Scores of score_quality(), which says how odd rows are taken; one row for each row of `docs`."""
    return score_quality(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: RuleModel) -> DataFrame:
    """The documents predicted to be good, with their columns, those named score or predicted too.

    Null texts are judged as empty ones; repeated rows stay or go together; no rows give no rows."""
    p = free_prefix(docs)
    kept = {c: p + c for c in docs.columns if c in ("score", "predicted")}
    return score_quality(docs.withColumnsRenamed(kept), model).where("predicted = 1").select(*[F.col(kept.get(c, c)).alias(c) for c in docs.columns])
