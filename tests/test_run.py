import json

import pytest
from pyspark.sql import functions as F

from tessera import run, settings
from tessera.operators import blocks, quality, topology
from tessera.sources import container, csvs


def test_whole_run(spark, tmp_path):
    (tmp_path / "domain.csv").write_text('wkt\n"POLYGON ((0 0, 400 0, 400 300, 0 300, 0 0))"\n"POLYGON ((1000 0, 1200 0, 1200 200, 1000 200, 1000 0), (1050 50, 1050 150, 1150 150, 1150 50, 1050 50))"\n"POLYGON ((0 0, 1 0, 1 1, 0 0))"\n')
    rows = "\n".join(" ".join(str(100 + 0.01 * c + 0.02 * r) for c in range(130)) for r in range(40))
    (tmp_path / "z.asc").write_text(f"ncols 130\nnrows 40\nxllcorner -20\nyllcorner -20\ncellsize 10\nNODATA_value -9999\n{rows}\n")
    given = {"input": {"domain": "domain.csv", "dem": "z.asc"}, "mesh": {"min_element_area": 625.0, "global_min_size": 50.0, "max_iterations": 2}, "output": {"directory": "out"}}
    (tmp_path / "s.json").write_text(json.dumps(given))
    s = settings.load(str(tmp_path / "s.json"))
    lines = []
    r = run.run(spark, s, run.regular(50.0), lines.append)
    # 8 x 6 cells, and 4 x 4 without the 2 x 2 of the hole
    assert r.elem.count() == 2 * (48 + 12) and r.summary["area_total_km2"] == pytest.approx(0.15)
    assert {(x.block, x["count"]) for x in r.elem.groupBy("block").count().collect()} == {(1, 96), (2, 24)}
    assert r.fit.agg(F.max("rmse")).collect()[0][0] < 1e-6
    assert any(x.startswith("in all: no element is too small") for x in lines)
    out = str(tmp_path / "out")
    faces = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/face.csv")
    assert faces.count() == 120 and faces.where("wkt like 'POLYGON%' and area = 1250").count() == 120
    edges = csvs.text_table(spark, f"{out}/edge.csv", ("CN", "LN"))
    assert edges.count() == 2 * 360
    mesh = container.read(spark, f"{out}/block_000/mesh.bin", "edge")
    half = topology.half_edges(r.elem)
    assert mesh.count() == topology.edges(half).count() and mesh.where("face_right = 0 and fr <> 0.35").count() == 0
    assert json.loads((spark.read.text(f"{out}/summary.json").collect()[0]).value)["n_elements"] == 120


def test_blocks_side_by_side(spark):
    elem = spark.createDataFrame([(b, i, 3, 0, 1, 2, None) for b in (0, 1) for i in range(2)], "block int, eid long, kind int, n0 long, n1 long, n2 long, n3 long")
    nodes = spark.createDataFrame([(b, i, float(i), float(b)) for b in (0, 1) for i in range(3)], "block int, id long, x double, y double")
    e, n = blocks.side_by_side(elem, nodes)
    assert sorted((r.block, r.eid, r.n0, r.n2) for r in e.collect()) == [(1, 0, 0, 2), (1, 1, 0, 2), (2, 2, 3, 5), (2, 3, 3, 5)]
    assert sorted(r.id for r in n.collect()) == list(range(6))


def test_summaries_over_blocks(spark):
    rows = [(10, 4, 6, 1.0, 5.0, 50.0, 20.0, 1, 2, 0.1), (30, 10, 20, 3.0, 4.0, 60.0, 30.0, 0, 1, 0.3)]
    t = spark.createDataFrame(rows, "n_elements long, n_triangles long, n_quads long, area_total_km2 double, area_min double, area_max double, area_median double, viol_area_below_min long, viol_any long, rmse_area_weighted double")
    r = blocks.over_blocks(t).collect()[0]
    assert (r.n_elements, r.area_min, r.area_max, r.area_median, r.viol_any) == (40, 4, 60, 30, 3)
    assert r.rmse_area_weighted == pytest.approx(0.25) and r.viol_any_ratio == pytest.approx(3 / 40)
    text = blocks.report_lines(r.asDict(), quality.Limits(), run.terrain.Limits())
    assert text[0].startswith("elements: 40") and "some elements are too small" in text[-1]
    assert blocks.report_lines({"n_elements": 0}, quality.Limits(), run.terrain.Limits()) == []


def test_bank_lines(spark):
    rows = [(1, k / 10, float(k), 0.0, float(k), 9.0) for k in range(5)] + [(1, 3 + k / 10, float(k), 0.0, float(k), float("nan")) for k in range(3)]
    got = blocks.bank_lines(spark.createDataFrame(rows, "river int, kp double, lx double, ly double, rx double, ry double"), 0.5).collect()
    assert sorted((r.part, r.bank, len(r.pts)) for r in got) == [(0, "left", 5), (0, "right", 5), (1, "left", 3)]
