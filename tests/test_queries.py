"""Every registered query of the library's own operators against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

from omicspark.plans import queries as Q, queries_io, queries_more  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    rows = [r.asDict() for r in df.collect()]
    if name not in Q.SQL:
        assert rows
        return
    result = duck.execute(Q.SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    got = sorted(tuple(plain(r[c]) for c in order) for r in rows)
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall())
    assert got == want and got
