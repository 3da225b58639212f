"""How many windows collocations are counted from."""

import random


def test_windows_are_at_most_one_a_word(spark):
    """However large a group of copies or of rows with common words is; and all windows count as often as their words begin one."""
    from tallyweb.llm.collocations import counted_windows, frequent_slots

    def sizes(rows):
        docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
        bits = frequent_slots(docs, 5, 3, 1 << 11)
        r = counted_windows(docs, bits, 5, 3).selectExpr("count_if(phrase <> '') AS rows", "sum(n) FILTER (WHERE phrase <> '') AS begun", "sum(n) FILTER (WHERE phrase = '') AS words").first()
        return r["rows"], r["begun"], r["words"]

    text = " ".join(f"w{i}" for i in range(50))
    assert sizes([(text, "en")] * 20) == (50, 1000, 1000)
    assert sizes([(text, "en")] * 400) == (50, 20_000, 20_000)
    rnd = random.Random(9)
    mixed = [(" ".join(["the", f"w{rnd.randrange(40)}"] * 20), "en") for _ in range(300)]
    rows, begun, words = sizes(mixed)
    assert rows <= begun <= words == 300 * 40


def test_few_rare_words_begin_windows(spark):
    """A rare word has to meet a frequent one in each table of slots; in a single table 1 of 16 does here."""
    from tallyweb.llm.collocations import counted_windows, frequent_slots

    rows = [(" . ".join(f"often{i}" for i in range(1024)), "en")] * 20
    rows += [(" . ".join(f"rare{i}" for i in range(at, at + 500)), "en") for at in range(0, 20_000, 500)]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(2)
    windows = counted_windows(docs, frequent_slots(docs, 20, 1, 1 << 14), 5, 1).where("phrase <> ''")
    assert windows.where("phrase LIKE '%often%'").groupBy("phrase").sum("n").where("`sum(n)` = 20").count() == 1024
    assert windows.where("phrase LIKE '%rare%'").count() < 600
