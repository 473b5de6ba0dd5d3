"""Every registered query of the linkage operators against its SQL."""

import math

import pytest

from kindred.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool) or not hasattr(v, "__float__"):
        return (1, str(v))
    x = float(v)
    return (1, f"{x:.9g}" if math.isfinite(x) else str(x))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(cols).collect())
    if name not in ORACLES:
        assert got
        return
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
