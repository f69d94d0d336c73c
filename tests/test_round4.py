"""What the fourth round of findings showed: a cell file and a container are made and read in parts, never as one value."""

import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera import catalog_io
from tessera.operators.export import LANDUSE_CODES, SOIL_CODES
from tessera.sources import cellbin, container


def whole(files, *order):
    return {m: b"".join(bytes(r.bytes) for r in sorted((r for r in files.collect() if r.mesh == m), key=lambda r: [r[c] for c in order])) for m in {r.mesh for r in files.select("mesh").distinct().collect()}}


def test_no_part_grows_with_the_mesh(spark, sf_dir):
    files = catalog_io.cell_file(spark, sf_dir)
    parts = files.select(F.length("bytes").alias("n")).collect()
    assert len(parts) > 7 and max(r.n for r in parts) <= cellbin.PART_FACES * (cellbin.FACE.itemsize + 4 * cellbin.SIDE.itemsize)
    made = cellbin.converted(files)
    assert max(r.n for r in made.select(F.length("bytes").alias("n")).collect()) <= container.PART_ROWS * 60
    one = spark.createDataFrame([(0, bytearray(whole(files, "part")[0]))], "mesh long, bytes binary")  # a file as it is on disk
    data = whole(made, "section", "part")
    assert whole(cellbin.converted(one), "section", "part") == data
    got = container.decode(data[0])
    raw = [data[0][at : at + n] for at, n in container.decode_header(data[0])[3]]
    assert got["hashes"] == [container.digest(x) for x in raw] and len(got["face"]) == cellbin.unpacked(files)[0].count()


def small(spark):
    """Two faces in two parts of a file, which share side 1; node 4 is missing."""
    area = [0.0, 2.5] + [0.0] * (len(LANDUSE_CODES) - 2)
    face = lambda eid, ratio: (7, eid, eid + 1, 3, 0.5, 0.5, 1.0, 9.0, ratio, 0.0, area, [1.5] + [0.0] * (len(SOIL_CODES) - 1), 0)
    kinds = {"<i4": "int", "<f8": "double"}
    fields = lambda d: ", ".join(f"{n} {'array<double>' if d[n].shape else kinds[d[n].str]}" for n in d.names)

    def side(eid, k, en, v1, v2):
        row = dict.fromkeys(cellbin.SIDE.names, 0.0) | {"en": en, "bc": 0, "cn": eid + 1, "cn_end": 0, "v1": v1, "v2": v2, "x1": 10.0 * v1, "x2": 10.0 * v2, "zc": 1.0 + eid}
        return (7, eid, k, *row.values())

    faces = spark.createDataFrame([face(0, 0.5), face(300, 0.0)], f"mesh long, eid long, {fields(cellbin.FACE)}")
    sides = [side(0, 0, 1, 1, 2), side(0, 1, 2, 2, 3), side(0, 2, 3, 3, 1), side(300, 0, 4, 2, 5), side(300, 1, 1, 2, 1), side(300, 2, 5, 1, 5)]
    return cellbin.packed(faces, spark.createDataFrame(sides, f"mesh long, eid long, k int, {fields(cellbin.SIDE)}"))


def test_parts_meet_in_the_container(spark, monkeypatch):
    monkeypatch.setattr(cellbin, "NODE_RUN", 2)
    monkeypatch.setattr(container, "PART_ROWS", 2)
    files = small(spark)
    assert sorted(r.part for r in files.collect()) == [0, 1, 2]
    made = cellbin.converted(files)
    rows = lambda section, *names: [tuple(r) for r in container.unpacked(made, section, "mesh").select(*names).orderBy(*names[:1]).collect()]
    assert rows("edge", "id", "v1", "v2", "face_left", "face_right", "z_crest")[0] == (1, 1, 2, 1, 301, 1.0) and len(rows("edge", "id")) == 5
    assert rows("node", "id", "x", "mesh") == [(1, 10.0, 7), (2, 20.0, 7), (3, 30.0, 7), (4, 0.0, 7), (5, 50.0, 7)]
    assert rows("face", "id", "edge_ids", "n_sides", "block", "level") == [(1, [1, 2, 3], 3, 1, None), (301, [4, 1, 5], 3, 1, None)]
    assert rows("landuse", "face_id", "code", "area") == [(1, LANDUSE_CODES[1], 2.5), (301, LANDUSE_CODES[1], 2.5)]
    assert rows("soil", "face_id", "code", "area") == [(1, SOIL_CODES[0], 1.5), (301, SOIL_CODES[0], 1.5)]
    assert rows("building", "face_id", "chi") == [(1, 0.5)] and rows("couple", "edge_id") == []
    less = made.where("not (section = 2 and part = 1)")
    with pytest.raises(container.ContainerError):
        container.unpacked(less, "edge", "mesh")


def test_a_cell_file_without_a_part_is_refused(spark):
    files = small(spark)
    for less in (files.where("part <> 2"), files.where("part <> 0")):
        with pytest.raises(cellbin.CellFileError):
            cellbin.converted(less)
        with pytest.raises(cellbin.CellFileError):
            cellbin.unpacked(less)
    data = whole(files, "part")[7]
    assert struct.unpack_from("<iii", data, 2 * cellbin.PATH_BYTES) == (2, 6, 2)
    with pytest.raises(Exception, match="within a side"):
        cellbin.converted(spark.createDataFrame([(7, bytearray(data[:-1]))], "mesh long, bytes binary"))


def test_a_container_in_parts_has_the_same_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(container, "PART_ROWS", 3)
    ids = spark.range(1, 11).select((F.col("id") % 2).alias("mesh"), F.col("id").cast("int").alias("id"))
    zero = lambda *names: [F.lit(0.5).alias(n) for n in names]
    nodes = ids.select("*", *zero("x", "y", "z"))
    edges = ids.select("*", *[F.col("id").alias(n) for n in ("v1", "v2", "face_left", "face_right")], *zero("z_crest", "fr"))
    face = ids.select("*", F.lit(0).alias("dummy"), *zero("x", "y", "A", "z_bed"), F.lit(2).alias("n_sides"), F.array("id", "id").alias("edge_ids"), F.col("id").alias("block"), (F.col("id") % 4).alias("level"))
    built = ids.where("mesh = 1").select("mesh", F.col("id").alias("face_id"), *zero("chi", "perimeter"))
    want = container.packed(edges, nodes, face, {"building": built}, epsg=6670, levels=(4, 1))
    got = container.parts(edges, nodes, face, {"building": built}, epsg=6670, levels=(4, 1))
    data = whole(want)
    assert whole(got, "section", "part") == data and len(data) == 2
    container.write(got, str(tmp_path))
    assert {m: (tmp_path / f"block_{m:03d}" / "mesh.bin").read_bytes() for m in (0, 1)} == data
    for section in ("node", "edge", "face", "building", "couple"):
        a, b = (container.unpacked(f, section, "mesh") for f in (want, got))
        assert a.schema == b.schema and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_a_reader_holds_few_parts(spark, monkeypatch):
    monkeypatch.setattr(cellbin, "PART_FACES", 4)
    monkeypatch.setattr(container, "PART_ROWS", 8)
    ids = spark.range(400).coalesce(1)
    none = lambda n: F.array(*[F.lit(0.0)] * n)
    zero = lambda *names: [F.lit(0.0).alias(n) for n in names]
    e, m = F.col("id"), F.lit(0).cast("long").alias("mesh")
    faces = ids.select(m, e.alias("eid"), (e + 1).cast("int").alias("cn"), F.lit(1).alias("n_edge"), *zero("x", "y", "A", "z_bed", "ratio", "perimeter"), none(len(LANDUSE_CODES)).alias("land"), none(len(SOIL_CODES)).alias("soil"), F.lit(0).alias("dummy"))
    whole_numbers = {"en": e + 1, "bc": F.lit(1), "cn": e + 1, "cn_end": F.lit(0), "v1": e + 1, "v2": e + 2}
    sides = ids.select(m, e.alias("eid"), F.lit(0).alias("k"), *[whole_numbers[n].cast("int").alias(n) if n in whole_numbers else F.lit(0.0).alias(n) for n in cellbin.SIDE.names])
    files = cellbin.packed(faces, sides)
    made = cellbin.converted(files)
    assert files.count() == 101 and container.unpacked(made, "edge", "mesh").count() == 400
    for df in (files, made):
        held = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in df.inputFiles()]
        assert sum(x.num_rows for x in held) >= 100
        assert max(x.row_group(i).num_rows for x in held for i in range(x.num_row_groups)) <= 16
