"""The stages against plain versions, each on what the one before kept."""

import collections

import corpus_pipeline as p
from tallyweb.llm.quality_rules import score_quality, train_quality

from .test_operators import lower, words

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in p.STAGES[:-1]:
        stage(spark, kept[-1], SF).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
        assert kept[-1].columns == docs.columns
    all_, good, lines, single, clean = map(rows_of, kept)

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_quality(docs, train_quality(docs, labels))
    assert set(good) == {r["doc_id"] for r in scored.where("score >= 0.5").collect()} and len(good) < len(all_)

    key = lambda x: lower(x.strip("\x20\t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, t in good.items():
        for x in t.split("\n"):
            holders[key(x)].add(i)
    cut = lambda i, t: "\n".join(x for x in t.split("\n") if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == i)
    assert lines == {i: cut(i, t) for i, t in good.items()}

    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in lines.items() if (w := words(t))}
    root = {i: i for i in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert set(single) == {find(i) for i in lines}

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    sizes = {len(x) for x in windows}
    hit = lambda w: any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    assert set(clean) == {i for i, t in single.items() if not hit(words(t))} and len(clean) < len(single)

    packed = p.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == set(clean)
