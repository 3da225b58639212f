"""Branches of large nodes are dealt over tasks; the verdicts must be those of undealt ones."""

from tallyweb.llm import url_filter


def test_dealt_branches_change_no_verdict(spark, monkeypatch):
    pages = spark.range(400).selectExpr(
        "id AS page_id",
        "concat('http://', if(id % 4 = 0, 'b', 'a'), '.com/', array('shop', 'blog', 'news')[id % 3], '/', translate(id, '0123456789', 'abcdefghij'), '/', array('x', 'y')[id % 2]) AS url",
    )
    rules = [("a.com/shop/", "block"), ("a.com/blog/", "allow"), ("b.com/news/b", "block")]
    got = {}
    for size in (10_000, 7):
        monkeypatch.setattr(url_filter, "NODE_PATHS", size)
        got[size] = sorted(tuple(r) for r in url_filter.judge_urls(pages, rules).collect())
    assert len(got[7]) == 400 and got[7] == got[10_000]
    assert {r[4] for r in got[7]} == {"allow", "block"} and len({r[5] for r in got[7]}) > 2
