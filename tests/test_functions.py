import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from tallyweb.functions import text, urls
from tallyweb.operators.products import rounded


def values(spark, column, inputs):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_parse_price(spark):
    cases = {
        "$1,299.00": (1299.0, "USD"), "$10.99 - $12.00": (10.99, "USD"), "₹ 999": (999.0, "INR"), "Rs. 1,299.00": (None, "INR"),
        "Rs.1,299": (0.1299, "INR"), "1.299,00 €": (1.299, "EUR"), "CAD $5": (5.0, "USD"), "$5.00.": (None, "USD"),
        "free offers 20": (20.0, "INR"), "20 dollars": (20.0, "INR"), "Call us": (None, None), "": (None, None),
    }
    got = values(spark, text.parse_price, [*cases, None])
    assert [tuple(g) for g in got] == [*cases.values(), (None, None)]


def test_extract_price_text(spark):
    cases = {"now Rs. 1,299.00 only": "Rs. 1,299.00", "from USD 45.50": "USD 45.50", "offers 20 today": "rs 20", "price £3.": "£3.", "GBP 5": None, "INR500": None}
    assert values(spark, text.extract_price_text, list(cases)) == list(cases.values())


def test_numbers(spark):
    assert values(spark, text.parse_int, ["1,234 reviews", "(57)", "none", "0", None, "9" * 30]) == [1, 57, None, 0, None, None]
    assert values(spark, text.parse_float, ["Rated 4.5 out of 5", "4.5.", "...", None]) == [4.5, None, None, None]


def test_stock(spark):
    cases = {"In Stock": True, "https://schema.org/InStock": True, "https://schema.org/OutOfStock": False, "Out of stock": False, "unavailable": True, "Preorder": None, "": None}
    assert values(spark, text.infer_in_stock, list(cases)) == list(cases.values())


def test_clean_text(spark):
    assert values(spark, text.clean_text, ["  a \n\t b ", "a  b", " 　 ", "", None]) == ["a b", "a b", None, None, None]


def test_phone_or_nav(spark):
    assert values(spark, text.looks_like_phone_or_nav, ["+12345678", "1234567", "Home lamp", "blue bolt", None]) == [True, False, True, False, False]


def test_product_like_path(spark):
    cases = {
        "https://a.com/": False, "https://a.com/index.html": False, "https://a.com/product/9": True, "https://a.com/search/all": False,
        "https://a.com/about.html": True, "https://a.com/x/y": True, "https://a.com/x": False, "https://a.com/red-shoe": True, "https://a.com/q?pid=3": True,
    }
    assert values(spark, urls.is_product_like_path, list(cases)) == list(cases.values())


def test_blacklisted_link(spark):
    cases = {"mailto:x": True, "https://a.com/border-collie": True, "https://helpful.com/product/1": True, "https://a.com/product/1": False, "": True, None: True}
    assert values(spark, urls.is_blacklisted_link, list(cases)) == list(cases.values())


def test_to_absolute_is_urljoin(spark):
    refs = ["/p/1", "z", "../z", "?page=2", "#f", "//cdn.b.com/i.png", "javascript:void(0)", "", "https://b.com/q?x", "./a/../b/", "/a//b/./c/..", "../../../z", "g;x=1?y#s", " /q ", "a b/c", ".", ".."]
    bases = ["https://a.com/x/y?q=1", "https://a.com", "http://h.org/a/b/c/"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    for row in df.select("b", "r", urls.to_absolute(F.col("b"), F.col("r")).alias("got")).collect():
        assert row["got"] == (urljoin(row["b"], row["r"]) if row["r"] else None), row


def test_rounded_is_exact(spark):
    rnd = random.Random(3)
    xs = [2.675, 0.125, 1.005, 0.005, 0.015, 4.256, -0.0, 1e8 + 0.005] + [round(rnd.random() * 10 ** rnd.randint(0, 8), 3) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert all(r["y"] == round(r["x"], 2) for r in df.select("x", rounded(F.col("x")).alias("y")).collect())
