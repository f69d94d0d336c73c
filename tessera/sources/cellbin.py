"""The older cell file: two path fields, three counts, then each face followed by its sides.

A file of any size is a table of parts (mesh, part, bytes), which are the file in their order: part 0 begins with the
paths and counts, and a part ends where a face does. A task writes or reads a part, never a file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.cluster import cut, drop_cut, release, ship, spread
from tessera.operators import topology
from tessera.operators.export import LANDUSE_CODES, SOIL_CODES
from tessera.operators.tables import distance_weights

# Fixed values of the format.
PATH_BYTES = 1000
HEAD_BYTES = 2 * PATH_BYTES + 12
FACE = np.dtype([("cn", "<i4"), ("n_edge", "<i4"), *[(n, "<f8") for n in ("x", "y", "A", "z_bed", "ratio", "perimeter")], ("land", "<f8", len(LANDUSE_CODES)), ("soil", "<f8", len(SOIL_CODES)), ("dummy", "<i4")])
SIDE = np.dtype(
    [(n, "<i4") for n in ("en", "bc", "cn", "cn_end")] + [(n, "<f8") for n in ("a_cv", "dl", "cos_x", "cos_y", "w_self", "w_adj", "w_face")]
    + [("v1", "<i4"), ("v2", "<i4")] + [(n, "<f8") for n in ("x1", "y1", "z1", "x2", "y2", "z2", "xc", "yc", "zc", "length")]
)
PART_FACES = 256  # numbers of faces in a part: a quarter of a megabyte
GROUP_ROWS = 16  # parts that a reader holds
TASK_PARTS = 64
NODE_RUN = 1 << 16
COUNT, FACES, LAND, SOIL, BUILDING, SIDES, NODES = range(7)  # what a row of tables() is


class CellFileError(ValueError):
    """The bytes aren't a whole cell file."""


def side_rows(half: DataFrame, nodes: DataFrame, faces: DataFrame, lines: DataFrame, sampled: DataFrame | None = None) -> DataFrame:
    """The side records: eid, k and the fields of SIDE. nodes: id, x, y, z. faces: eid, x, y, A. sampled: ln, z at middles."""
    at = lambda which, n: nodes.select(F.col("id").alias(which), F.col("x").alias(f"x{n}"), F.col("y").alias(f"y{n}"), F.coalesce("z", F.lit(0.0)).alias(f"z{n}"))
    own = faces.select("eid", F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("A").alias("oa"))
    other = faces.select(F.col("eid").alias("neighbour"), F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("A").alias("na_"))
    t = topology.keyed(topology.neighbours(half)).join(spread(lines), ["lo", "hi"]).join(spread(at("na", 1)), "na").join(spread(at("nb", 2)), "nb").join(spread(own), "eid").join(spread(other), "neighbour", "left")
    t = t.join(spread(sampled.select("ln", F.col("z").alias("zs"))), "ln", "left") if sampled is not None else t.withColumn("zs", F.lit(None).cast("double"))
    c = F.col
    t = t.withColumns({"xc": (c("x1") + c("x2")) / 2, "yc": (c("y1") + c("y2")) / 2, "zc": F.coalesce("zs", (c("z1") + c("z2")) / 2), "length": F.hypot(c("x2") - c("x1"), c("y2") - c("y1"))})
    t = t.withColumns({"near": F.hypot(c("xc") - c("ox"), c("yc") - c("oy")), "far": F.hypot(c("xc") - c("nx"), c("yc") - c("ny")), "dx": F.coalesce("nx", "xc") - c("ox"), "dy": F.coalesce("ny", "yc") - c("oy")})
    t = t.withColumn("dl", F.hypot("dx", "dy"))
    cosine = lambda d: F.when(c("dl") > 1e-10, c(d) / c("dl")).otherwise(0.0)
    mine, adjacent, face = distance_weights(c("near"), c("far"))
    return t.select(
        "eid", "k", c("ln").cast("int").alias("en"), F.when(c("neighbour") < 0, 1).otherwise(0).alias("bc"), (c("eid") + 1).cast("int").alias("cn"), F.when(c("neighbour") < 0, 0).otherwise(c("neighbour") + 1).cast("int").alias("cn_end"),
        (c("oa") + F.coalesce("na_", F.lit(0.0))).alias("a_cv"), "dl", cosine("dx").alias("cos_x"), cosine("dy").alias("cos_y"), mine.alias("w_self"), adjacent.alias("w_adj"), face.alias("w_face"),
        (c("na") + 1).cast("int").alias("v1"), (c("nb") + 1).cast("int").alias("v2"), "x1", "y1", "z1", "x2", "y2", "z2", "xc", "yc", "zc", "length",
    )


def _records(table: pa.Table, dtype: np.dtype) -> np.ndarray:
    out = np.zeros(table.num_rows, dtype)
    for name in dtype.names:
        col = table.column(name)
        if dtype[name].shape:
            out[name] = pc.list_flatten(col).to_numpy().reshape(table.num_rows, -1)
        else:
            out[name] = col.to_numpy()
    return out


def packed(faces: DataFrame, sides: DataFrame, paths: tuple[str, str] = ("", "")) -> DataFrame:
    """mesh, part, bytes: the parts of one cell file for each mesh. faces: mesh, eid (from 0) and FACE's fields, land and soil as arrays; sides: mesh, eid, k, ...

    The parts are written to the shared folder once, as each table of a file is read from them.
    """
    ship(faces.sparkSession)
    head = b"".join(p.encode("utf-8", "replace")[:PATH_BYTES].ljust(PATH_BYTES, b" ") for p in paths)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("eid")
        right = right.sort_by([("eid", "ascending"), ("k", "ascending")])
        face, side = _records(left, FACE), _records(right, SIDE)
        ends = np.concatenate([[0], np.cumsum(face["n_edge"])])
        if ends[-1] != len(side):
            raise CellFileError("sides don't fit their faces")
        if left.column("eid")[0].as_py() < 0:
            raise CellFileError("faces count from 0")
        body = b"".join(face[i].tobytes() + side[ends[i] : ends[i + 1]].tobytes() for i in range(len(face)))
        return pa.table({"mesh": left.column("mesh").slice(0, 1), "part": left.column("part").slice(0, 1), "faces": pa.array([len(face)], pa.int64()), "sides": pa.array([len(side)], pa.int64()), "bytes": pa.array([body], pa.binary())})

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [head + struct.pack("<iii", n, m, n) for n, m in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([0] * len(data), pa.int64()), pa.array(data, pa.binary())], names=["mesh", "part", "bytes"])

    part = (F.floor(F.col("eid") / PART_FACES) + 1).cast("long")
    dealt = faces.withColumn("part", part).groupBy("mesh", "part").cogroup(sides.withColumnRenamed("mesh", "m").withColumn("p", part).groupBy("m", "p"))
    body = cut(dealt.applyInArrow(run, "mesh long, part long, faces long, sides long, bytes binary"), group_rows=GROUP_ROWS)
    release(faces.sparkSession)
    counts = body.groupBy("mesh").agg(F.sum("faces").alias("faces"), F.sum("sides").alias("sides"))
    return body.select("mesh", "part", "bytes").unionByName(counts.mapInArrow(heads, "mesh long, part long, bytes binary"))


def places(data: bytes, at: int) -> Iterator[tuple[list[int], list[int]]]:
    """(begins, ends) of the faces with their sides from a place on, for up to PART_FACES at a time."""
    while at < len(data):
        begins, ends = [], []
        while at < len(data) and len(begins) < PART_FACES:
            begins.append(at)
            at += FACE.itemsize
            if at > len(data):
                raise CellFileError("the file ends within a face")
            at += max(0, struct.unpack_from("<i", data, begins[-1] + 4)[0]) * SIDE.itemsize
            if at > len(data):
                raise CellFileError("the file ends within a side")
            ends.append(at)
        yield begins, ends


def first(data: bytes, part: int) -> int:
    """Where a part's faces begin."""
    if part == 0 and len(data) < HEAD_BYTES:
        raise CellFileError("the file ends within its counts")
    return HEAD_BYTES if part == 0 else 0


def slices(data: bytes, part: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(face records, side records) of a part, for up to PART_FACES faces at a time."""
    for begins, ends in places(data, first(data, part)):
        face = b"".join(data[b : b + FACE.itemsize] for b in begins)
        side = b"".join(data[b + FACE.itemsize : e] for b, e in zip(begins, ends, strict=True))
        yield np.frombuffer(face, FACE), np.frombuffer(side, SIDE)


def said(data: bytes, part: int) -> tuple[int | None, int | None]:
    """The numbers of faces and sides that a file says it has."""
    return struct.unpack_from("<ii", data, 2 * PATH_BYTES) if part == 0 else (None, None)


def checked(counts: DataFrame) -> None:
    """An error if the faces and sides of a file's parts (mesh, faces, sides, said_faces, said_sides) aren't as many as it says."""
    n = counts.groupBy("mesh").agg(*[F.sum(c).alias(c) for c in ("faces", "sides", "said_faces", "said_sides")])
    bad = n.where("not (faces <=> said_faces and sides <=> said_sides)").head()
    if bad:
        raise CellFileError(f"mesh {bad.mesh}: {bad.faces} faces and {bad.sides} sides, not {bad.said_faces} and {bad.said_sides}")


def in_parts(files: DataFrame) -> DataFrame:
    ship(files.sparkSession)
    return files.select(F.col("mesh").cast("long"), F.col("part").cast("long") if "part" in files.columns else F.lit(0).cast("long").alias("part"), "bytes")


def unpacked(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(faces, sides) of cell files (mesh, part, bytes; a whole file without part): FACE's fields with land and soil as arrays; SIDE's; both with mesh and seq, which rises within a file."""
    kind = {"<i4": "int", "<f8": "double"}
    files = in_parts(files)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mesh, part, data in zip(*batch.columns, strict=True):
                part, data = part.as_py(), data.as_py()
                found = [(len(f), len(s)) for f, s in slices(data, part)]
                row = (sum(n for n, _ in found), sum(n for _, n in found), *said(data, part))
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (mesh.as_py(), *row)], names=["mesh", "faces", "sides", "said_faces", "said_sides"])

    checked(files.mapInArrow(count, "mesh long, faces long, sides long, said_faces long, said_sides long"))

    def schema(dtype: np.dtype) -> str:
        return "mesh long, seq long, " + ", ".join(f"{n} {'array<double>' if dtype[n].shape else kind[dtype[n].str]}" for n in dtype.names)

    def column(values: np.ndarray) -> pa.Array:
        if values.ndim == 1:
            return pa.array(np.ascontiguousarray(values))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))

    def rows(which: int, dtype: np.dtype):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for mesh, part, data in zip(*batch.columns, strict=True):
                    seq = part.as_py() << 32
                    for found in slices(data.as_py(), part.as_py()):
                        got = found[which]
                        columns = [pa.array(np.full(len(got), mesh.as_py(), np.int64)), pa.array(seq + np.arange(len(got))), *[column(got[n]) for n in dtype.names]]
                        seq += len(got)
                        yield pa.RecordBatch.from_arrays(columns, names=["mesh", "seq", *dtype.names])

        return files.mapInArrow(run, schema(dtype))

    return rows(0, FACE), rows(1, SIDE)


def tables(files: DataFrame) -> DataFrame:
    """mesh, what, seq, i0..i4, d0..d3, ids: what normalised() takes from cell files, which are read once.

    COUNT: faces, sides, said faces and sides; FACES: cn, dummy, n_edge; x, y, A, z_bed; their sides. LAND, SOIL: cn,
    code; area. BUILDING: cn; ratio, perimeter. SIDES: en, cn, cn_end, v1, v2; zc. NODES: id; x, y, z, once a part.
    """
    names = ["mesh", "what", "seq", *[f"i{i}" for i in range(5)], *[f"d{i}" for i in range(4)], "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 5, *[pa.float64()] * 4, pa.list_(pa.int32())]

    def rows(mesh: int, what: int, n: int, whole: list, real: list, seq: np.ndarray | None = None, ids: pa.Array | None = None) -> pa.RecordBatch:
        columns = [np.full(n, mesh), np.full(n, what, np.int32), seq, *whole, *[None] * (5 - len(whole)), *real, *[None] * (4 - len(real)), ids]
        held = [pa.nulls(n, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(held, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mesh, part, data in zip(*batch.columns, strict=True):
                mesh, part, data = mesh.as_py(), part.as_py(), data.as_py()
                n_face = n_side = 0
                for face, side in slices(data, part):
                    seq = (part << 32) + n_side + np.arange(len(side))
                    ends = np.concatenate([[0], np.cumsum(np.maximum(face["n_edge"], 0))]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(side["en"])))
                    yield rows(mesh, FACES, len(face), [face[c].copy() for c in ("cn", "dummy", "n_edge")], [face[c].copy() for c in ("x", "y", "A", "z_bed")], ids=ids)
                    for what, field, codes in ((LAND, "land", LANDUSE_CODES), (SOIL, "soil", SOIL_CODES)):
                        i, j = np.nonzero(face[field] > 0)
                        yield rows(mesh, what, len(i), [face["cn"][i], np.array(codes, np.int32)[j]], [face[field][i, j]])
                    built = face[(face["ratio"] > 0) | (face["perimeter"] > 0)]
                    yield rows(mesh, BUILDING, len(built), [built["cn"].copy()], [built["ratio"].copy(), built["perimeter"].copy()])
                    yield rows(mesh, SIDES, len(side), [side[c].copy() for c in ("en", "cn", "cn_end", "v1", "v2")], [side["zc"].copy()], seq)
                    both = [np.stack([side[f"{c}1"], side[f"{c}2"]], 1).ravel() for c in "vxyz"]
                    node, at = np.unique(both[0], return_index=True)
                    yield rows(mesh, NODES, len(node), [node], [c[at] for c in both[1:]], 2 * seq[at // 2] + at % 2)
                    n_face, n_side = n_face + len(face), n_side + len(side)
                counts = [None if v is None else np.array([v], np.int32) for v in (n_face, n_side, *said(data, part))]
                yield rows(mesh, COUNT, 1, counts, [])

    files = in_parts(files)
    few = files.repartition(files.count() // TASK_PARTS + 1, "mesh", "part")  # a batch is what a task has, up to 64 MB
    return few.mapInArrow(run, "mesh long, what int, seq long, " + ", ".join(f"i{i} int" for i in range(5)) + ", " + ", ".join(f"d{i} double" for i in range(4)) + ", ids array<int>")


def normalised(rows: DataFrame) -> dict[str, DataFrame]:
    """node, edge, face, landuse, soil and building tables of cell files' tables().

    A side's first record gives its direction, left face and height; a later one of another face is on the right if none
    was. A node's first record gives its place; missing numbers up to the largest become nodes at the origin.
    """

    def of(what: int, *names: str) -> DataFrame:
        columns = dict(zip([*[f"i{i}" for i in range(5)], *[f"d{i}" for i in range(4)]], names, strict=True))
        return rows.where(F.col("what") == what).select("mesh", "seq", *[F.col(c).alias(n) for c, n in columns.items() if n], "ids")

    sides = of(SIDES, "en", "cn", "cn_end", "v1", "v2", "zc", "", "", "")
    side = F.struct("seq", "cn", "cn_end", "v1", "v2", "zc")
    edges = sides.groupBy("mesh", "en").agg(F.min(side).alias("a"), F.sort_array(F.collect_list(F.struct("seq", "cn"))).alias("all"))
    later = F.filter("all", lambda s: s["cn"] != F.col("a.cn"))
    right = F.when(F.col("a.cn_end") != 0, F.col("a.cn_end")).when(F.size(later) > 0, later[0]["cn"]).otherwise(0)
    edge = edges.select("mesh", F.col("en").alias("id"), F.col("a.v1").alias("v1"), F.col("a.v2").alias("v2"), F.col("a.cn").alias("face_left"), right.alias("face_right"), F.col("a.zc").alias("z_crest"), F.lit(0.0).alias("fr"))
    node = of(NODES, "id", "", "", "", "", "x", "y", "z", "").groupBy("mesh", "id").agg(F.min_by(F.struct("x", "y", "z"), "seq").alias("p")).select("mesh", "id", "p.x", "p.y", "p.z")
    # numbers come in runs: all of a mesh in one array would be a row that grows with it
    runs = of(NODES, "id", "", "", "", "", "", "", "", "").groupBy("mesh").agg(F.max("id").alias("n")).select("mesh", "n", F.explode(F.sequence(F.lit(1), F.col("n"), F.lit(NODE_RUN))).alias("from"))
    every = runs.select("mesh", F.explode(F.sequence("from", F.least(F.col("n"), F.col("from") + (NODE_RUN - 1)))).alias("id"))
    node = every.join(spread(node), ["mesh", "id"], "left").select("mesh", "id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in "xyz"])
    face = of(FACES, "id", "dummy", "n_sides", "", "", "x", "y", "A", "z_bed").withColumn("block", F.lit(1)).withColumnRenamed("ids", "edge_ids")
    sparse = lambda what: of(what, "face_id", "code", "", "", "", "area", "", "", "").drop("seq", "ids")
    building = of(BUILDING, "face_id", "", "", "", "", "chi", "perimeter", "", "").drop("seq", "ids")
    return {"node": node, "edge": edge, "face": face.drop("seq"), "landuse": sparse(LAND), "soil": sparse(SOIL), "building": building}


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("mesh"), F.col("content").alias("bytes"))
    return unpacked(files)


def converted(files: DataFrame, epsg: int = 0) -> DataFrame:
    """mesh, section, part, bytes: the newer containers, in parts, of cell files (mesh, part, bytes)."""
    from tessera.sources import container

    rows = cut(tables(files))
    checked(rows.where(F.col("what") == COUNT).select("mesh", *[F.col(f"i{i}").alias(n) for i, n in enumerate(("faces", "sides", "said_faces", "said_sides"))]))
    t = normalised(rows)
    made = container.parts(t["edge"], t["node"], t["face"], {k: t[k] for k in ("landuse", "soil", "building")}, epsg=epsg)
    drop_cut(rows)
    release(files.sparkSession)
    return made
