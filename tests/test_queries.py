"""Every core query against its SQL in DuckDB over the smallest tables."""

import os

import duckdb
import pytest

from clipsieve.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str([plain(x) for x in v]) if isinstance(v, list | tuple) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = duck.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())


def test_entry_without_llm(spark):
    import __spark_entry__ as e

    assert set(registry.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
