"""Collocations, periodic runs and language ids against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweb.llm import queries
from tallyweb.llm.collocations import collocations
from tallyweb.llm.language_id import identify, languages_digest, predict, train_languages
from tallyweb.llm.periodic_runs import find_runs, runs_digest, runs_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"


# --- Collocations --------------------------------------------------------------------------------------------------


def plain_collocations(rows, least, top, most=5, percent=100):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(most, len(words) - i) + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    for (lang, p), a in candidates.items():
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        held = any(g == lang and len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (g, q), b in candidates.items())
        if not held:
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(p), a, left, right, n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    placed, at = [], Counter()
    for r in out:
        at[r[0]] += 1
        if at[r[0]] <= top:
            placed.append((r[0], at[r[0]], *r[1:]))
    return placed


def got_collocations(spark, rows, least, top, **more):
    df = collocations(spark.createDataFrame(rows, "text string, lang string").repartition(3), min_count=least, top=top, **more)
    return sorted(tuple(r) for r in df.collect())


def some_texts(seed, n=60):
    r = random.Random(seed)
    words = ["a", "The", "of", "é", "x\x00y", "\x01", "b\x1f", "猫", "a\x01\x02"]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "  \t", ", ", ".\n", " "]) for _ in range(r.randrange(40)))
    return [(r.choice([None, "", text(), text(), text(), text()]), r.choice(["en", "en", "fr", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_are_those_of_a_plain_version(spark, seed):
    rows = some_texts(seed)
    want = plain_collocations(rows, 3, 25)
    assert len(want) > 20
    assert got_collocations(spark, rows, 3, 25) == sorted(want)


def test_collocations_do_not_depend_on_the_table_of_slots(spark):
    rows = some_texts(3, 80)
    want = sorted(plain_collocations(rows, 4, 9, most=3, percent=60))
    for pruned in (1, 3):  # nearly every slot is frequent
        assert got_collocations(spark, rows, 4, 9, max_words=3, drop_percent=60, pruned=pruned, table_size=1 << 11) == want


def test_collocations_across_batches(spark):
    """Phrases whose rows are dealt to many small batches and ranges."""
    rows = some_texts(4, 150)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert got_collocations(spark, rows, 5, 2000) == sorted(plain_collocations(rows, 5, 2000))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_collocations_of_odd_rows(spark):
    assert got_collocations(spark, [], 1, 5) == []
    assert got_collocations(spark, [(None, "en"), ("", None), (" ,.\n", "en")], 1, 5) == []
    long = "new york " * 30_000
    (row,) = got_collocations(spark, [(long, "en")], 29_999, 5, max_words=2)[:1]
    assert row == ("en", 1, "new york", 30_000, 30_000, 30_000, 60_000, 2_000)
    clashing = spark.createDataFrame([("a b a b", "en", 1, 2, "x")], "text string, lang string, phrase int, n int, words string")
    assert {r["phrase"] for r in collocations(clashing, min_count=2, top=5).collect()} == {"a b"}


def test_scores_beyond_64_bits(spark):
    from tallyweb.llm.collocations import scored

    big = 3 * 10**12
    rows = [("en", "", 0, 7 * 10**12 + 1), ("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a\0b", 2, big - 7)]
    (r,) = scored(spark.createDataFrame(rows, "lang string, phrase string, n_words int, a long")).collect()
    assert r["score"] == 1000 * (big - 7) * (7 * 10**12 + 1) // (big * (big - 1)) and r["phrase"] == "a b"


# --- Periodic runs -------------------------------------------------------------------------------------------------


def plain_runs(words, least):
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            part = words[i : i + size]
            if size >= max(least, 2 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=60), min_size=1, max_size=4), st.sampled_from([1, 2, 5, 12]), st.integers(1, 9), st.integers(0, 20))
def test_runs_are_those_of_a_plain_version(docs, least, period, begin):
    docs = [[w if i < begin else d[begin + (i - begin) % period] for i, w in enumerate(d)] if len(d) > begin + period else d for d in docs]
    ids = np.array([w for d in docs for w in d], dtype=np.int64)
    got = runs_of(ids, np.repeat(np.arange(len(docs)), [len(d) for d in docs]), least) if len(ids) else {}
    for i, d in enumerate(docs):
        assert got.get(i, []) == plain_runs(d, least)


def test_words_of_famous_sequences():
    a, b = [1], [1, 2]
    while len(b) < 400:
        a, b = b, b + a
    morse = [1 + bin(i).count("1") % 2 for i in range(512)]
    for word in (b, morse, [1] * 500, list(range(1, 300))):
        assert runs_of(np.array(word), np.zeros(len(word), dtype=np.int64), 12).get(0, []) == plain_runs(word, 12)


def test_runs_query_against_a_plain_version(spark):
    docs = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert got.keys() == docs.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    with_runs = 0
    for i, text in docs.items():
        words, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        # a plain search over all periods is slow for long texts: these are looked at by their own periods only
        runs = plain_runs(words, 12) if n < 400 else None
        r = got[i]
        if runs is None:
            continue
        with_runs += bool(runs)
        kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + size for s, size, q in runs)]
        assert (r["n_runs"], r["collapsed_sha256"]) == (len(runs), sha(" ".join(kept)))
        assert r["runs_sha256"] == sha("".join(f"{s},{size},{q}\n" for s, size, q in runs))
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == top
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
    assert with_runs > 10


def test_runs_of_odd_rows(spark):
    assert find_runs(spark.createDataFrame([], DOCS)).count() == 0
    long = "w " * 200_000
    rows = [(1, None, "en"), (1, "", None), (None, " \n", "en"), (2, long, "en"), (3, "a b " * 6 + "c", "en"), (3, "a b " * 6 + "c", "en")]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], DOCS + ", runs int, collapsed string")
    got = sorted((r["doc_id"] or 0, r["collapsed"], [tuple(x) for x in r["runs"]]) for r in find_runs(df).collect())
    assert got == [(0, "", []), (1, "", []), (1, "", []), (2, "w", [(0, 200_000, 1)]), (3, "a b c", [(0, 12, 2)]), (3, "a b c", [(0, 12, 2)])]
    none = runs_digest(df.where("doc_id = 1")).first()
    assert none["n_runs"] == 0 and none["start"] is None and none["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()


def test_periodic_ends_of_odd_rows(spark):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = [(ids[0], None, "en"), (ids[1], " \t\n ", "en"), (ids[2], "one", "en"), (None, "a b", "en"), (ids[3], None, None)]
    got = {(r["doc_id"], r["text"]) for r in queries.with_periodic_ends(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(ids[0], None), (ids[1], " \t\n "), (ids[2], "one"), (None, "a b"), (ids[3], None)}


# --- Language identification ---------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["lang"] for r in queries.table(spark, sf, "documents").collect()}
    rows = queries.op13_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in held) >= 0.99 * len(held) > 200


def plain_grams(text, orders):
    words = re.split(r"[^\w]+|[\d_]+", (text or "").lower())
    joined = " " + " ".join(w for w in words if w) + " "
    return [joined[i : i + k] for k in range(1, orders + 1) for i in range(len(joined) - k + 1) if k > 1 or joined[i] != " "]


def test_probabilities_are_those_of_a_plain_version(spark):
    rows = [("der Hund und die Katze", "de"), ("the dog and the cat", "en"), ("Le chien, 2 chats", "fr"), ("the end", "en"), ("", "en"), (None, "fr"), ("12 !", "de"), ("und", None)]
    model = train_languages(spark.createDataFrame(rows, "text string, lang string"), buckets=1 << 20)
    assert model.langs == ["de", "en", "fr"]
    counts = {x: Counter(g for t, lang in rows if lang == x for g in (plain_grams(t, 3) if re.search("[a-z]", t or "") else [])) for x in model.langs}
    texts = {x: sum(lang == x and bool(re.search("[a-z]", t or "")) for t, lang in rows) for x in model.langs}

    def plain(text):
        logs = []
        for x in model.langs:
            total = sum(counts[x].values()) + 0.5 * (1 << 20)
            logs.append(np.log((texts[x] + 0.5) / (sum(texts.values()) + 1.5)) + sum(np.log((counts[x][g] + 0.5) / total) for g in plain_grams(text, 3)))
        p = np.exp(np.array(logs) - max(logs))
        return model.langs[int(p.argmax())], p.max() / p.sum()

    asked = ["the cat", "die Hund", "Chien!", "zzz", "a"]
    langs, scores = predict(asked, model)
    for text, lang, score in zip(asked, langs, scores, strict=True):
        assert (lang, pytest.approx(score, rel=1e-4)) == plain(text)


def test_languages_of_odd_rows(spark):
    rows = [(1, "the dog", "en"), (2, "der Hund", "de"), (3, None, "en"), (4, "", None), (5, "12, 34", "de"), (None, "the", "en"), (6, "the dog " * 300_000, "xx"), (1, "the dog", "en")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((r["doc_id"] or 0, r["held_out"], r["lang_pred"], r["score"] == 0) for r in languages_digest(docs, F.col("doc_id") == 6).collect())
    assert got == [(0, False, "en", False), (1, False, "en", False), (1, False, "en", False), (2, False, "de", False), (3, False, "und", True), (4, False, "und", True), (5, False, "und", True), (6, True, "en", False)]
    none = train_languages(docs.where("lang IS NULL"))
    clashing = docs.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))
    assert {(r["lang_pred"], r["score"]) for r in identify(clashing, none).collect()} == {("und", 0.0)}
    assert identify(docs.limit(0), none).count() == 0
    with pytest.raises(ValueError, match="languages"):
        train_languages(spark.range(20_000).select(F.lit("a").alias("text"), F.col("id").cast("string").alias("lang")))
