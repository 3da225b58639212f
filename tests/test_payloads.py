from tallyweb.sources.payloads import load_manual_urls, parse_url_payload

CASES = [
    ('["u1",{"url":"u2","max_items":5},7]', [("u1", None), ("u2", 5)]),
    ('{"urls":["u1"]}', [("u1", None)]),
    ('"u1"', [("u1", None)]),
    ("u1, u2", [("u1", None), ("u2", None)]),
    ('# c\n\nu1\n{"url":"u2"}', [("u1", None), ("u2", None)]),
    ('{"url":"u3"}', [("u3", None)]),
    ("  \n ", []),
    (None, []),
    ('"q"\n12\n[1]', [("q", None), ("12", None), ("[1]", None)]),
    ("[1]]", [("[1]]", None)]),
]


def test_payloads(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "payload_id long, text string")
    got = {i: [] for i in range(len(CASES))}
    for r in parse_url_payload(df).orderBy("payload_id", "pos").collect():
        got[r["payload_id"]].append((r["url"], r["max_items"]))
    assert got == {i: e for i, (_, e) in enumerate(CASES)}


def test_manual_urls_in_order(spark):
    one = spark.createDataFrame([(0, '["a", ""]')], "payload_id long, text string")
    two = spark.createDataFrame([(0, "b\nc")], "payload_id long, text string")
    assert [r["url"] for r in load_manual_urls(one, two).orderBy("source", "pos").collect()] == ["a", "b", "c"]
