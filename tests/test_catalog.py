"""Every registered core query against its SQL in DuckDB, over the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from feedmill.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert name in catalog.ORACLES, "every query of the catalog has its SQL"
    got = duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert ours == sorted((tuple(plain(r[i]) for i in at) for r in got.fetchall()), key=repr)


def test_flagship_has_rows(spark):
    assert catalog.flagship(spark, SF).count() > 0


def test_sitemap_rows_go_on_without_the_keys_of_their_map(spark):
    """Each row once carried all keys of its map into the shuffle by slug."""
    node = __import__("__spark_entry__").queries()["sitemap_candidates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Window":
        node = node.children().head()
    assert "url#" in node.children().head().output().toString() and "keys#" not in node.children().head().output().toString()
