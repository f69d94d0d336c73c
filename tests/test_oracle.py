"""Every registered query that has SQL is held against DuckDB at the smallest scale."""

import math

import duckdb
import pytest

from tessera import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, duck, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    cur = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in sorted(names)]
    want = sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=str)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in sorted(names)]).collect()), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all(x == y or (isinstance(x, float) and y is not None and abs(x - y) <= 2e-6 * max(1, abs(x))) for x, y in zip(a, b, strict=True)), (a, b)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, sf_dir, name):
    assert catalog.queries()[name](spark, sf_dir).count() > 0
