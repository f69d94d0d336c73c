import numpy as np
import pytest

from tessera.llm.search import BallTree, TopK, exact_top_k
from tessera.llm.vectors import Quantiser, near_duplicates
from tests.llm.test_dedup import classes

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows(n=300, dim=8, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = (centres[rng.integers(0, 12, n)] + rng.normal(0, 0.15, (n, dim))).astype(np.float32)
    v[10:40] = v[10]  # copies
    out = [(i, v[i].tolist(), 1) for i in range(n)]
    out += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * dim, 1), (n + 3, [float("nan")] * dim, 1), (n + 4, [None] + [1.0] * (dim - 1), 1), (n + 5, [float("inf")] + [1.0] * (dim - 1), 1), (n + 6, [2 * x for x in v[3].tolist()], 1), (n + 50, [1.0, 2.0], 1)]
    return out


def usable(r):
    return r[1] and all(x is not None and np.isfinite(x) for x in r[1])


@pytest.mark.parametrize("shard_rows", [1000, 60])
def test_top_k_equals_brute_force(spark, shard_rows):
    data = rows()
    out = exact_top_k(spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as id", "2 as part", "3 as dim"), k=5, query_where="vec_id % 10 = 0", shard_rows=shard_rows, block_rows=16, shards_per_task=2).collect()
    good = [(r[0], np.floor(256 * np.array(r[1], np.float32).astype(np.float64))) for r in data if usable(r)]
    want = []
    for i, q in good:
        if i % 10 == 0:
            found = sorted(((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q)))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == sorted(want)


@pytest.mark.parametrize("shard_rows", [1000, 30])
def test_top_k_of_large_values_is_exact(spark, shard_rows):
    rng = np.random.default_rng(9)
    v = [[float(x) for x in np.floor(rng.normal(0, 1, 4) * 10.0 ** rng.integers(0, 7))] for _ in range(100)]
    v[7], v[8], v[50], v[51] = [1e200, 0.0, 0.0, 0.0], [1e10, 1e10, 0.0, 1.0], [1e308, 1.0, -1e308, 0.0], [1e10, 1.0, 0.0, 0.0]
    data = [(i, x) for i, x in enumerate(v)]
    out = exact_top_k(spark.createDataFrame(data, "vec_id long, embedding array<double>"), k=5, query_where="vec_id % 5 = 0", shard_rows=shard_rows, block_rows=8, shards_per_task=2).collect()
    whole = [(i, [int(np.floor(256 * c)) if abs(256 * c) < np.inf else int(np.copysign(np.finfo(float).max, c)) for c in x]) for i, x in data]
    want = []
    for i, q in whole:
        if i % 5 == 0:
            scores = sorted((-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(q, p, strict=True)))), j) for j, p in whole if j != i)[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == sorted(want)


def test_near_duplicates_of_large_ids(spark):
    data = [(5 * 10**18 + i, [1.0, i / 100]) for i in range(6)] + [(-(5 * 10**18), [0.0, 1.0])]
    out = {r.id: r.component_id for r in near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    assert out == {i: min(i, 5 * 10**18) for i, _ in data}


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_top_k(empty, query_where="vec_id % 2 = 0").count() == near_duplicates(empty).count() == 0


def test_branch_and_bound_skips_and_is_exact():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.2, (600, 6)) for c in rng.normal(0, 5, (8, 6))])
    tree = BallTree(np.arange(len(points)), points)
    q = points[::100]
    best = TopK(q, np.full(len(q), -1), 3)
    seen = []
    scan = best.scan
    best.scan = lambda rows, tree, node: (seen.append(len(rows) * (tree.hi[node] - tree.lo[node])), scan(rows, tree, node))
    best.visit(np.arange(len(q)), tree)
    assert sum(seen) < 0.5 * len(q) * len(points)
    assert np.allclose(best.score, np.sort(q @ points.T, axis=1)[:, ::-1][:, :3])


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_near_duplicates_equal_brute_force(spark, block_rows):
    data = rows()
    out = near_duplicates(spark.createDataFrame(data + [(None, [1.0] * 8, 1)], SCHEMA), least=0.95, list_rows=30, block_rows=block_rows, sample_rows=100).collect()
    good = {r[0]: np.array(r[1], np.float32).astype(np.float64) for r in data if usable(r) and any(r[1])}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    want = classes(links, [r[0] for r in data])
    assert len(out) == len(data) + 1
    for r in out:
        if r.id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert r.n_links == sum(r.id in p for p in links)
            assert (r.component_id, r.kept) == (want[r.id], want[r.id] == r.id)


def test_probes_and_codes_bound_distances():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    model = Quantiser(x[:120], 20, subspaces=4, codes=8)
    home, codes, error = model.encode(x)
    probes = model.probes(x, 0.4)
    for c in range(len(model.centres)):
        inside = np.flatnonzero(home == c)
        true = np.sqrt(((x[:, None] - x[inside][None]) ** 2).sum(-1))
        assert probes[:, c][(true <= 0.4).any(axis=1)].all()
        assert (np.sqrt(model.asymmetric(x, c, codes[inside])) - error[inside] <= true + 1e-9).all()
