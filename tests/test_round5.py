"""What the fifth round of findings showed: special edges that touch, and features whose number repeats."""

import duckdb
import numpy as np
import pytest

from tessera import catalog
from tessera.operators import special

#: Two pairs whose touch isn't met by rounded arithmetic, and numbers that the shifted copies (feature + 1000000) take too.
PARTS = [13339, 57190, 13525, 57376, *range(400), *range(1_000_000, 1_000_400)]


@pytest.fixture(scope="module")
def parts(tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    duckdb.sql(f"COPY (SELECT unnest({PARTS})::BIGINT p_partkey) TO '{folder}/part.parquet'")
    return str(folder)


def both(spark, parts, name):
    """Rows of a query and of its SQL, in order."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{parts}/part.parquet'")
    cur = con.execute(catalog.oracle_sql()[name])
    df = catalog.queries()[name](spark, parts)
    return sorted(tuple(r) for r in df.select(*[f"`{d[0]}`" for d in cur.description]).collect()), sorted(cur.fetchall())


def test_conflicts_of_touching_and_repeated_features(spark, parts):
    got, want = both(spark, parts, "special_edge_conflicts")
    assert got == want and (13339, 57190, "gap", 0.0) in want and len(set(want)) > 100


def test_report_of_touching_and_repeated_features(spark, parts):
    got, want = both(spark, parts, "special_edge_report")
    assert got == want and want[0][5] == 0


def test_picks_of_touching_and_repeated_features(spark, parts):
    got, want = both(spark, parts, "special_edge_picks")
    assert got == want and len(set(want)) < len(want)


def test_picks_of_dense_features_make_few_pairs(spark, monkeypatch):
    n, made = 1500, []
    rng = np.random.default_rng(7)
    a, d = rng.integers(0, 150, (n, 2)).astype(float), rng.integers(-8, 9, (n, 2)).astype(float)
    b = a + d
    near = np.zeros((n, n), bool)
    i, j = np.triu_indices(n, 1)
    gap, kind = special._related(*a[i].T, *b[i].T, *a[j].T, *b[j].T)
    near[i, j] = near[j, i] = (gap < 10) & (kind != 1)
    open_, want = np.ones(n, bool), []
    for k in np.lexsort((np.arange(n), -np.sqrt((d**2).sum(axis=1)))):
        if open_[k]:
            want.append(int(k))
            open_ &= ~near[k]
    subset = special.clear_subset
    monkeypatch.setattr(special, "clear_subset", lambda items, pairs: made.append(pairs.count()) or subset(items, pairs))
    f = spark.createDataFrame([(k, *map(float, (*a[k], *b[k]))) for k in range(n)], "feature long, ax double, ay double, bx double, by double")
    assert sorted(r.feature for r in special.clear_features(f, 10.0, 40.0, at_once=100).collect()) == sorted(want)
    assert len(made) > 1 and 20 * sum(made) < near.sum() / 2


def test_picks_without_ends_or_number(spark):
    rows = [(1, None, 0.0, 1.0, 1.0), (2, float("nan"), 0.0, 1.0, 1.0), (3, 0.0, 0.0, 5.0, 0.0), (4, 0.0, 1.0, 4.0, 1.0), (None, 90.0, 90.0, 99.0, 90.0)]
    f = spark.createDataFrame(rows, "feature long, ax double, ay double, bx double, by double")
    for at_once in (1, 100):
        assert sorted(r.feature for r in special.clear_features(f, 2.0, 16.0, at_once=at_once).collect()) == [1, 2, 3]


def test_long_slanting_segments_meet_once(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(-400, 400, (150, 2)).astype(float)
    b = a + rng.integers(-300, 300, (150, 2)) * rng.choice([0.05, 1.0], (150, 1))
    b[:5, 0] = a[:5, 0]
    rows = [(i, *map(float, (*a[i], *b[i]))) for i in range(150)]
    i, j = np.triu_indices(150, 1)
    gap, _ = special._related(*a[i].T, *b[i].T, *a[j].T, *b[j].T)
    for reach in (5.0, 40.0):
        f = spark.createDataFrame([*rows, (150, None, 0.0, 1.0, 1.0)], "feature long, ax double, ay double, bx double, by double")
        got = sorted((r.i, r.j) for r in special.relations(f, reach, 16.0).collect())
        assert got == sorted(zip(i[gap < reach].tolist(), j[gap < reach].tolist(), strict=True)) and len(got) > 100


def test_ends_beyond_all_cells_are_an_error(spark):
    f = spark.createDataFrame([(1, 0.0, 0.0, 1e300, 0.0), (2, 0.0, 1.0, 4.0, 1.0)], "feature long, ax double, ay double, bx double, by double")
    with pytest.raises(Exception, match="too far out"):
        special.relations(f, 2.0, 16.0).collect()
    assert special.clear_features(f.limit(0), 2.0, 16.0).count() == special.relations(f.limit(0), 2.0, 16.0).count() == 0
