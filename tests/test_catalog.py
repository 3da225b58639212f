"""Each registered query of the library against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

from tallyweb import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(set(catalog.SQL) - {"q8_process_queue"}))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    sql = db.sql(catalog.SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(sql.columns)
    at = [sql.columns.index(c) for c in columns]
    want = sorted([plain(r[i]) for i in at] for r in sql.fetchall())
    assert sorted([plain(v) for v in r] for r in df.select(*columns).collect()) == want


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


def test_strategies_read_the_pages_of_every_template(spark, monkeypatch):
    read, made = [], catalog.part_pages
    monkeypatch.setattr(catalog, "part_pages", lambda part: read.append(part.count()) or made(part))
    names = [n for n in catalog.QUERIES if n[:3] in ("e1_", "e2_", "e3_", "e4_", "e5_", "e6_")]
    for name in names:
        catalog.QUERIES[name](spark, SF)
    assert len(names) == 6 and read == [catalog.table(spark, SF, "part").count()] * 6
