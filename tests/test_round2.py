"""What the second round of findings showed: exact ties, segments without length, the same answers from less memory."""

from pyspark.sql import functions as F

from tessera import catalog
from tessera.operators import ordering, special, tables, terrain
from tessera.sources import msh


def test_whole_numbers_give_planes_rounded_once(spark):
    pts = [(1, 11.0, -11.0, 48.0), (1, -14.0, 5.0, 34.0), (1, 19.0, -11.0, 25.0), (2, -8.0, -14.0, 43.0), (2, -3.0, -15.0, 44.0), (2, 12.0, -3.0, 47.0)]
    fit = terrain.plane_fit(spark.createDataFrame(pts, "face long, dx double, dy double, z double"))
    got = {r.face: r for r in fit.collect()}
    assert got[1].a == -2.875 and got[1].c == 20.5859375  # a tie at six places
    assert got[2].slope == 0.2 and got[2].b == 0
    spread = fit.select("face", F.lit(90.0).alias("spread"))
    assert {r.face: r.bad_spread for r in terrain.violations(fit, spread).collect()} == {1: True, 2: False}


def test_planes_keep_their_digits_at_any_height(spark):
    pts = [(1, x, y, 1e6 + 0.001 * x) for x in (0.0, 1.0, 2.0) for y in (0.0, 1.0)]
    got = terrain.plane_fit(spark.createDataFrame(pts, "face long, dx double, dy double, z double")).collect()[0]
    assert abs(got.a - 0.001) < 1e-8 and got.rmse < 1e-6


def test_doubles_are_rounded_themselves(spark):
    b = 41 / 640  # just under its shortest text, 0.0640625
    t = spark.createDataFrame([(b, float("inf"), 1e300, None)], "a double, i double, h double, n double")
    assert tuple(catalog.rounded(t).collect()[0]) == (0.064062, float("inf"), 1e300, None)


def test_segments_without_length_have_relations(spark):
    t = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 0.0), (2, 3.0, 4.0, 9.0, 4.0), (3, 9.0, 4.0, 9.0, 4.0), (4, 5.0, 4.0, 12.0, 4.0)], "feature long, ax double, ay double, bx double, by double")
    got = {(r.i, r.j): (r.relation, r.gap) for r in special.relations(t, 10.0, 16.0).collect()}
    assert got == {(1, 2): ("overlap", 5.0), (1, 3): ("overlap", 97**0.5), (1, 4): ("overlap", 41**0.5), (2, 3): ("cross", 0.0), (2, 4): ("overlap", 0.0), (3, 4): ("overlap", 0.0)}


def test_picks_are_the_same_in_rounds_and_in_one_task(spark):
    n = 60
    items = spark.createDataFrame([(i, float(i * 37 % 19)) for i in range(n)], "feature long, length double")
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if (i * 7 + j * 11) % 13 == 0]
    conflicts = spark.createDataFrame(pairs, "i long, j long")
    kept = []
    for i in sorted(range(n), key=lambda i: (-(i * 37 % 19), i)):
        if not any((min(i, k), max(i, k)) in set(pairs) for k in kept):
            kept.append(i)
    for in_task in (0, 10, 1000):
        assert sorted(r.feature for r in special.clear_subset(items, conflicts, in_task=in_task).collect()) == sorted(kept)


def test_many_components_are_ordered_in_few_tasks(spark):
    parts = [[(10 * p + a, 10 * p + b) for a, b in ((0, 3), (3, 1), (1, 4), (4, 0), (4, 2))[: p % 6]] for p in range(12)]
    pairs, faces = [x for p in parts for x in p], sorted({10 * p + i for p in range(12) for i in range(5)})
    links = spark.createDataFrame(pairs, "e0 long, e1 long")
    part = ordering.components(links, spark.createDataFrame([(f,) for f in faces], "face long"))
    low = {r.face: r.component for r in part.collect()}
    groups = {c: [f for f in faces if low[f] == c] for c in sorted(set(low.values()))}
    assert sorted(low) == faces and all(low[a] == low[b] for a, b in pairs) and all(min(g) == c for c, g in groups.items())
    order = [f for g in groups.values() for f in ordering.cuthill_mckee(g, [x for x in pairs if x[0] in g])]
    got = {r.face: r.new for r in ordering.bandwidth_order(links, part).collect()}
    assert got == {f: len(order) - k for k, f in enumerate(order)}


def test_mesh_files_are_read_in_splits(spark, tmp_path):
    n = 3000
    nodes = spark.createDataFrame([(i, float(i), float(i % 7)) for i in range(n + 2)], "id long, x double, y double")
    elem = spark.createDataFrame([(i, 3, i, i + 1, i + 2, None, 1) for i in range(n)], "eid long, kind int, n0 long, n1 long, n2 long, n3 long, surface int")
    msh.write(elem, nodes, str(tmp_path / "m"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert spark.read.text(str(tmp_path / "m")).rdd.getNumPartitions() > 5  # a file isn't one row of one task
        cells, places = msh.read(spark, str(tmp_path / "m"))
        assert sorted((r.eid, r.n0, r.n1, r.n2) for r in cells.collect()) == [(i, i, i + 1, i + 2) for i in range(n)]
        assert sorted((r.id, r.x) for r in places.collect()) == [(i, float(i)) for i in range(n + 2)]
        assert "wholetext" not in cells._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_merged_faces_need_no_rows(spark):
    faces = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "block long, cn long")
    assert sorted((r.block, r.cn) for r in tables.merged_faces(faces).collect()) == [(1, 1), (1, 2), (2, 3), (3, 4)]
