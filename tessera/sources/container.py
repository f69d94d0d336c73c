"""The solver's binary mesh container: nine sections of fixed records, their hashes, and two optional trailers.

Records are numpy structured types, so a section is one buffer. Spark reads containers with the binaryFile source and
decodes each file in one task; it writes one container for each group of rows.

A container of any size is a table of parts (mesh, section, part, bytes), which are the container in the order of section
and part: section 0 is the header, 1 to 9 are the sections, 10 and 11 the trailers. A task holds a part, not a container.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tessera.cluster import cut, ship

# Fixed values of the format.
MAGIC, BLOCK_MAGIC, LEVEL_MAGIC = b"AQWAMESH", b"AQWABLK1", b"AQWALTS1"
VERSION, HASH_BYTES, HEADER_BYTES = 1, 16, 320
NODE = np.dtype([("id", "<i4"), ("x", "<f8"), ("y", "<f8"), ("z", "<f8")])
EDGE = np.dtype([("id", "<i4"), ("v1", "<i4"), ("v2", "<i4"), ("face_left", "<i4"), ("face_right", "<i4"), ("z_crest", "<f8"), ("fr", "<f8")])
EDGE_OLD = np.dtype(EDGE.descr[:-1])
FACE = np.dtype([("id", "<i4"), ("dummy", "<i4"), ("x", "<f8"), ("y", "<f8"), ("A", "<f8"), ("z_bed", "<f8"), ("n_sides", "<i4")])
SPARSE = np.dtype([("face_id", "<i4"), ("code", "<i4"), ("area", "<f8")])
BUILDING = np.dtype([("face_id", "<i4"), ("chi", "<f8"), ("perimeter", "<f8")])
VEGETATION = np.dtype([("face_id", "<i4"), ("chi", "<f8"), ("a", "<f8"), ("hv", "<f8"), ("cd", "<f8")])
VEGETATION_OLD = np.dtype(VEGETATION.descr[:2])
SPECIAL = np.dtype([("edge_id", "<i4"), ("kind", "<i4"), ("zc", "<f8"), ("H", "<f8"), ("z_road", "<f8"), ("qgroup", "<i4"), ("B", "<f8")])
SPECIAL_OLD = np.dtype(SPECIAL.descr[:-1])
COUPLE = np.dtype([("edge_id", "<i4"), ("river_link", "<i4"), ("kp", "<f8"), ("bank", "<i4")])
SECTIONS = ("node", "edge", "face", "landuse", "soil", "building", "vegetation", "special", "couple")
COUNTED = {"landuse": (SPARSE,), "soil": (SPARSE,), "building": (BUILDING,), "vegetation": (VEGETATION, VEGETATION_OLD), "special": (SPECIAL, SPECIAL_OLD), "couple": (COUPLE,)}
BLOCKS, LEVELS = len(SECTIONS) + 1, len(SECTIONS) + 2
PART_ROWS = 4096  # numbers in a part
GROUP_ROWS = 16  # parts that a reader holds
TASK_PARTS = 64
LEAD = -(1 << 62)  # the part of a count or trailer's head, before the parts of rows


class ContainerError(ValueError):
    """The bytes aren't a container, or contradict themselves."""


def digest(data: bytes) -> bytes:
    """First 16 bytes of SHA-256; zeros for no data."""
    return hashlib.sha256(data).digest()[:HASH_BYTES] if data else bytes(HASH_BYTES)


def records(rows: dict[str, np.ndarray] | None, dtype: np.dtype) -> np.ndarray:
    out = np.zeros(len(next(iter(rows.values()))) if rows else 0, dtype)
    for name in dtype.names:
        if rows and name in rows:
            out[name] = rows[name]
    return out


def encode_faces(faces: np.ndarray, edge_ids: list[list[int]]) -> bytes:
    """Each face's head followed by its edge numbers."""
    out = []
    for head, ids in zip(faces, edge_ids, strict=True):
        if head["n_sides"] != len(ids):
            raise ContainerError(f"face {head['id']}: {head['n_sides']} sides, {len(ids)} edges")
        out += [head.tobytes(), np.asarray(ids, "<i4").tobytes()]
    return b"".join(out)


def decode_faces(data: bytes, n: int) -> tuple[np.ndarray, list[list[int]]]:
    heads, ids, at = np.zeros(n, FACE), [], 0
    for i in range(n):
        if at + FACE.itemsize > len(data):
            raise ContainerError("faces end early")
        heads[i] = np.frombuffer(data, FACE, 1, at)[0]
        at += FACE.itemsize
        k = int(heads[i]["n_sides"])
        if k < 0 or at + 4 * k > len(data):
            raise ContainerError("faces end early")
        ids.append(np.frombuffer(data, "<i4", k, at).tolist())
        at += 4 * k
    if at != len(data):
        raise ContainerError("bytes after the last face")
    return heads, ids


def encode_counted(rows: np.ndarray) -> bytes:
    return struct.pack("<I", len(rows)) + rows.tobytes()


def decode_counted(data: bytes, forms: tuple[np.dtype, ...]) -> np.ndarray:
    """Rows after their count; shorter old records get zeros, no bytes mean no rows."""
    if not data:
        return np.zeros(0, forms[0])
    n = struct.unpack_from("<I", data)[0]
    for form in forms:
        if len(data) == 4 + n * form.itemsize:
            got = np.frombuffer(data, form, n, 4)
            return records({c: got[c] for c in form.names}, forms[0]) if n else np.zeros(0, forms[0])
    raise ContainerError(f"{n} records don't fit {len(data)} bytes")


def decode_edges(data: bytes, n: int) -> np.ndarray:
    for form in (EDGE, EDGE_OLD):
        if len(data) == n * form.itemsize:
            got = np.frombuffer(data, form)
            return records({c: got[c] for c in form.names}, EDGE) if n else np.zeros(0, EDGE)
    raise ContainerError(f"{n} edges don't fit {len(data)} bytes")


def encode_blocks(blocks: np.ndarray) -> bytes:
    ids = np.asarray(blocks, "<i4")
    if (ids < 1).any():
        raise ContainerError("blocks count from 1")
    return BLOCK_MAGIC + struct.pack("<I", len(ids)) + ids.tobytes()


def encode_levels(levels: np.ndarray, most: int, binning: int) -> bytes:
    ids = np.asarray(levels, "<i4")
    if (ids < 0).any():
        raise ContainerError("levels count from 0")
    return LEVEL_MAGIC + struct.pack("<IIII", 1, most, binning, len(ids)) + ids.tobytes()


def _trailer(data: bytes, magic: bytes, head: int, n_faces: int) -> np.ndarray | None:
    if len(data) < head or data[:8] != magic:
        return None
    n = struct.unpack_from("<I", data, head - 4)[0]
    if n != n_faces or len(data) < head + 4 * n:
        raise ContainerError("a trailer's length isn't the number of faces")
    return np.frombuffer(data, "<i4", n, head).copy()


def decode_blocks(data: bytes, n_faces: int) -> np.ndarray | None:
    return _trailer(data, BLOCK_MAGIC, 12, n_faces)


def decode_levels(data: bytes, n_faces: int) -> tuple[np.ndarray, int, int] | None:
    """(levels, largest, binning) or None without the trailer."""
    ids = _trailer(data, LEVEL_MAGIC, 24, n_faces)
    if ids is None:
        return None
    version, most, binning = struct.unpack_from("<III", data, 8)
    if version != 1:
        raise ContainerError(f"unknown version of levels: {version}")
    return ids, most, binning


def encode_header(counts: list[int], hashes: list[bytes], sizes: list[int], epsg: int) -> bytes:
    """counts: nodes, edges, faces; hashes and sizes by section."""
    ends = np.cumsum([HEADER_BYTES, *sizes])
    head = struct.pack("<8sHHiIIII", MAGIC, VERSION, 0, epsg, *counts, 0)
    index = b"".join(struct.pack("<QQ", int(at), n) for at, n in zip(ends[:-1], sizes, strict=True))
    return head + b"".join(h[:HASH_BYTES].ljust(HASH_BYTES, b"\0") for h in hashes) + index


def decode_header(data: bytes) -> tuple[int, list[int], list[bytes], list[tuple[int, int]]]:
    """(epsg, counts of nodes, edges and faces, hashes, places and sizes of the sections)."""
    if len(data) < HEADER_BYTES:
        raise ContainerError("too short")
    magic, version, _, epsg, *counts, _ = struct.unpack_from("<8sHHiIIII", data)
    if magic != MAGIC or version != VERSION:
        raise ContainerError(f"not a container of version {VERSION}")
    hashes = [data[32 + HASH_BYTES * i : 32 + HASH_BYTES * (i + 1)] for i in range(len(SECTIONS))]
    return epsg, counts, hashes, [struct.unpack_from("<QQ", data, 32 + HASH_BYTES * len(SECTIONS) + 16 * i) for i in range(len(SECTIONS))]


def encode(tables: dict[str, np.ndarray], edge_ids: list[list[int]], *, epsg: int = 0, blocks: np.ndarray | None = None, levels: tuple[np.ndarray, int, int] | None = None, hashes: list[bytes] | None = None) -> bytes:
    """A container of record arrays by section; missing sections are empty, blocks default to 1."""
    face = tables["face"]
    parts = [tables["node"].tobytes(), tables["edge"].tobytes(), encode_faces(face, edge_ids)]
    parts += [encode_counted(tables.get(s, np.zeros(0, forms[0]))) for s, forms in COUNTED.items()]
    sums = hashes or [digest(p) for p in parts]
    out = encode_header([len(tables[s]) for s in SECTIONS[:3]], sums, [len(p) for p in parts], epsg) + b"".join(parts)
    out += encode_blocks(np.ones(len(face)) if blocks is None else blocks)
    return out if levels is None else out + encode_levels(*levels)


def decode(data: bytes) -> dict:
    """Record arrays by section, with edge_ids, blocks, levels (None without them), hashes and epsg."""
    epsg, (n_node, n_edge, n_face), hashes, index = decode_header(data)
    if any(at + n > len(data) for at, n in index):
        raise ContainerError("a section ends beyond the file")
    raw = {s: data[at : at + n] for s, (at, n) in zip(SECTIONS, index, strict=True)}
    if len(raw["node"]) != n_node * NODE.itemsize:
        raise ContainerError("nodes don't fit their count")
    faces, edge_ids = decode_faces(raw["face"], n_face)
    out = {"node": np.frombuffer(raw["node"], NODE), "edge": decode_edges(raw["edge"], n_edge), "face": faces, "edge_ids": edge_ids, "hashes": hashes, "epsg": epsg}
    out |= {s: decode_counted(raw[s], forms) for s, forms in COUNTED.items()}
    tail = data[max([HEADER_BYTES, *(at + n for at, n in index)]) :]
    out["blocks"] = decode_blocks(tail, n_face)
    rest = tail[12 + 4 * n_face :] if out["blocks"] is not None else tail
    out["levels"] = decode_levels(rest, n_face)
    return out


def _filled(batch: pa.RecordBatch, dtype: np.dtype) -> np.ndarray:
    """One record a row. A missing double is NaN; a missing whole number is an error."""
    out = np.zeros(batch.num_rows, dtype)
    for name in dtype.names:
        col = batch.column(batch.schema.get_field_index(name))
        if dtype[name].kind == "f":
            out[name] = col.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
        elif col.null_count:
            raise ContainerError(f"{name} is missing in a record")
        else:
            out[name] = col.cast(pa.int64()).to_numpy(zero_copy_only=False)
    return out


def _row_bytes(batch: pa.RecordBatch, dtype: np.dtype) -> list[bytes]:
    data, size = _filled(batch, dtype).tobytes(), dtype.itemsize
    return [data[i : i + size] for i in range(0, len(data), size)]


def packed(edges: DataFrame, nodes: DataFrame, faces: DataFrame, attributes: dict[str, DataFrame] | None = None, *, epsg: int = 0, levels: tuple[int, int] | None = None) -> DataFrame:
    """mesh, bytes: one container for each mesh, which is the column that all tables have.

    A container is one file and one task writes it; meshes are written in parallel, and rows become records before they
    are grouped. edges and nodes have their records' columns; faces also have edge_ids and block, and level if ``levels``
    (the largest level, the code of its binning) is given. attributes: section -> rows with its records' columns.
    """
    ship(nodes.sparkSession)
    attributes = attributes or {}
    fields = "mesh long, part int, seq long, record binary, edge_ids array<int>, block int, level int"

    def rows(df: DataFrame, section: str, dtype: np.dtype) -> DataFrame:
        part = SECTIONS.index(section)
        face = section == "face"
        extra = [F.col("edge_ids").cast("array<int>"), F.col("block").cast("int"), (F.col("level").cast("int") if levels else F.lit(None).cast("int")).alias("level")] if face else [F.lit(None).cast("array<int>").alias("edge_ids"), F.lit(None).cast("int").alias("block"), F.lit(None).cast("int").alias("level")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                seq = batch.column(batch.schema.get_field_index(dtype.names[0])).cast(pa.int64())
                held = {c: batch.column(batch.schema.get_field_index(c)) for c in ("mesh", "edge_ids", "block", "level")}
                yield pa.RecordBatch.from_arrays([held["mesh"].cast(pa.int64()), pa.array(np.full(n, part, np.int32)), seq, pa.array(_row_bytes(batch, dtype), pa.binary()), held["edge_ids"], held["block"], held["level"]], names=["mesh", "part", "seq", "record", "edge_ids", "block", "level"])

        names = [F.col(c) for c in dtype.names if c not in ("edge_ids", "block", "level")]
        return df.select("mesh", *names, *extra).mapInArrow(run, fields)

    every = rows(nodes, "node", NODE).unionByName(rows(edges, "edge", EDGE)).unionByName(rows(faces, "face", FACE))
    for section, table in attributes.items():
        every = every.unionByName(rows(table, section, COUNTED[section][0]))

    def run(table: pa.Table) -> pa.Table:
        part, seq = table.column("part").to_numpy(), table.column("seq").to_numpy()
        tables, face = {}, np.zeros(0, np.int64)
        for section in SECTIONS:
            mine = np.flatnonzero(part == SECTIONS.index(section))
            mine = mine[np.argsort(seq[mine], kind="stable")]
            dtype = {"node": NODE, "edge": EDGE, "face": FACE}.get(section) or COUNTED[section][0]
            tables[section] = np.frombuffer(b"".join(table.column("record").take(pa.array(mine)).to_pylist()), dtype)
            if section == "face":
                face = mine
        faces = table.take(pa.array(face))
        got = (faces.column("level").to_numpy(), *levels) if levels else None
        data = encode(tables, faces.column("edge_ids").to_pylist(), epsg=epsg, blocks=faces.column("block").fill_null(1).to_numpy(), levels=got)
        return pa.table({"mesh": table.column("mesh").slice(0, 1), "bytes": pa.array([data], pa.binary())})

    return every.groupBy("mesh").applyInArrow(run, "mesh long, bytes binary")


def parts(edges: DataFrame, nodes: DataFrame, faces: DataFrame, attributes: dict[str, DataFrame] | None = None, *, epsg: int = 0, levels: tuple[int, int] | None = None) -> DataFrame:
    """mesh, section, part, bytes: what packed() gives, in parts of the shared folder.

    Rows are dealt by number. A section's hash runs over its parts in their order, a few of which are held at a time.
    """
    spark = nodes.sparkSession
    ship(spark)

    def rows(df: DataFrame, section: str, dtype: np.dtype) -> DataFrame:
        extra = ["edge_ids", "block", *(["level"] if levels else [])] if section == "face" else []

        def run(table: pa.Table) -> pa.Table:
            batch = table.take(pa.array(np.argsort(table.column(dtype.names[0]).to_numpy(), kind="stable"))).combine_chunks().to_batches()[0]
            held, code = _filled(batch, dtype), SECTIONS.index(section) + 1
            found = [(code, held.tobytes())]
            if section == "face":
                found = [(code, encode_faces(held, batch.column("edge_ids").to_pylist())), (BLOCKS, encode_blocks(batch.column("block").fill_null(1).to_numpy())[12:])]
                if levels:
                    found.append((LEVELS, encode_levels(batch.column("level").to_numpy(), *levels)[24:]))
            same = lambda v: pa.array([v] * len(found), pa.int64())
            return pa.table({"mesh": same(batch.column("mesh")[0].as_py()), "section": pa.array([c for c, _ in found], pa.int32()), "part": same(batch.column("part")[0].as_py()), "n": same(len(held)), "bytes": pa.array([b for _, b in found], pa.binary())})

        dealt = df.select(F.col("mesh").cast("long"), F.floor(F.col(dtype.names[0]) / PART_ROWS).cast("long").alias("part"), *dtype.names, *extra)
        return dealt.groupBy("mesh", "part").applyInArrow(run, "mesh long, section int, part long, n long, bytes binary")

    body = rows(nodes, "node", NODE).unionByName(rows(edges, "edge", EDGE)).unionByName(rows(faces, "face", FACE))
    for section, table in (attributes or {}).items():
        body = body.unionByName(rows(table, section, COUNTED[section][0]))
    body = cut(body, group_rows=GROUP_ROWS)
    codes = range(1, LEVELS + 1 if levels else LEVELS)
    every = body.select("mesh").distinct().select("mesh", F.explode(F.array(*[F.lit(c) for c in codes])).alias("section"))
    counts = every.join(body.groupBy("mesh", "section").agg(F.sum("n").alias("n")), ["mesh", "section"], "left").select("mesh", "section", F.coalesce("n", F.lit(0)).alias("n"))

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [struct.pack("<I", n) if c < BLOCKS else BLOCK_MAGIC + struct.pack("<I", n) if c == BLOCKS else LEVEL_MAGIC + struct.pack("<IIII", 1, *levels, n) for c, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([LEAD] * len(data), pa.int64()), pa.array(data, pa.binary())], names=["mesh", "section", "part", "bytes"])

    fields = "mesh long, section int, part long, bytes binary"
    lead = counts.where(F.col("section") > 3).mapInArrow(leads, fields)

    def sums(rows: Iterator[Row]) -> Iterator[tuple[int, int, int, bytes]]:
        for key, own in groupby(rows, lambda r: (r.mesh, r.section)):
            size, sha = 0, hashlib.sha256()
            for r in own:
                sha.update(r.bytes)
                size += len(r.bytes)
            yield *key, size, sha.digest()[:HASH_BYTES]

    within = body.select("mesh", "section", "part", "bytes").unionByName(lead).where(F.col("section") < BLOCKS)
    # a task has whole sections: as rows they come a few MB at a time, in an Arrow batch 64 MB
    ordered = within.repartition("mesh", "section").sortWithinPartitions("mesh", "section", "part")
    hashed = spark.createDataFrame(ordered.rdd.mapPartitions(sums), "mesh long, section int, size long, hash binary")

    def header(table: pa.Table) -> pa.Table:
        at = {r["section"]: r for r in table.to_pylist()}
        found = [at[i + 1] for i in range(len(SECTIONS))]
        data = encode_header([r["n"] for r in found[:3]], [r["hash"] or bytes(HASH_BYTES) for r in found], [r["size"] or 0 for r in found], epsg)
        return pa.table({"mesh": table.column("mesh").slice(0, 1), "section": pa.array([0], pa.int32()), "part": pa.array([LEAD], pa.int64()), "bytes": pa.array([data], pa.binary())})

    heads = counts.join(hashed, ["mesh", "section"], "left").groupBy("mesh").applyInArrow(header, fields)
    return body.select("mesh", "section", "part", "bytes").unionByName(cut(lead.unionByName(heads)))


def write(files: DataFrame, folder: str, name: str = "mesh.bin") -> None:
    """One file for each container (mesh, bytes, or its parts): <folder>/block_<mesh>/<name>, renamed when whole."""
    spark = files.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    ordered = files.orderBy("mesh", "section", "part") if "section" in files.columns else files
    for mesh, rows in groupby(ordered.toLocalIterator(), lambda r: int(r.mesh)):  # one partition at a time passes the driver
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/block_{mesh:03d}/{name}")
        part = jvm.org.apache.hadoop.fs.Path(f"{folder}/block_{mesh:03d}/_{name}.part")
        fs = path.getFileSystem(conf)
        out = fs.create(part, True)
        for r in rows:
            out.write(bytes(r.bytes))
        out.close()
        fs.delete(path, False)
        if not fs.rename(part, path):
            raise ContainerError(f"can't write {path}")


def sections(files: DataFrame) -> DataFrame:
    """mesh, section, bytes, hash: the nine work files of containers (mesh, bytes)."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mesh, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                index = [struct.unpack_from("<QQ", data, 32 + HASH_BYTES * len(SECTIONS) + 16 * i) for i in range(len(SECTIONS))]
                parts = [data[at : at + n] for at, n in index]
                yield pa.RecordBatch.from_arrays([pa.array([mesh] * len(parts), pa.int64()), pa.array(SECTIONS), pa.array(parts, pa.binary()), pa.array([digest(p) for p in parts], pa.binary())], names=["mesh", "section", "bytes", "hash"])

    return files.select(F.col("mesh").cast("long"), "bytes").mapInArrow(run, "mesh long, section string, bytes binary, hash binary")


def joined(work: DataFrame, epsg: int = 0) -> DataFrame:
    """mesh, bytes: containers put together again from work files (mesh, section, bytes), with their hashes."""
    ship(work.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        raw = dict(zip(table.column("section").to_pylist(), table.column("bytes").to_pylist(), strict=True))
        n_face, at, face = 0, 0, raw.get("face", b"")
        while at < len(face):
            at += FACE.itemsize + 4 * int(np.frombuffer(face, FACE, 1, at)["n_sides"][0])
            n_face += 1
        faces, ids = decode_faces(face, n_face)
        edge = raw.get("edge", b"")
        size = EDGE.itemsize if len(edge) % EDGE.itemsize == 0 else EDGE_OLD.itemsize
        tables = {"node": np.frombuffer(raw.get("node", b""), NODE), "edge": decode_edges(edge, len(edge) // size), "face": faces}
        tables |= {s: decode_counted(raw.get(s, b""), forms) for s, forms in COUNTED.items()}
        return pa.table({"mesh": table.column("mesh").slice(0, 1), "bytes": pa.array([encode(tables, ids, epsg=epsg)], pa.binary())})

    return work.groupBy("mesh").applyInArrow(run, "mesh long, bytes binary")


def read(spark: SparkSession, path: str, section: str) -> DataFrame:
    """One section of the containers under a path, as rows with the file's path."""
    return unpacked(spark.read.format("binaryFile").load(path).select("path", F.col("content").alias("bytes")), section, "path")


def checked(files: DataFrame, section: str, key: str) -> None:
    """An error if the parts of a section aren't as long as the header says."""
    code = SECTIONS.index(section)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [decode_header(data.as_py())[3][code][1] for data in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["key", "said"])

    said = files.where("section = 0").select(F.col(key).alias("key"), "bytes").mapInArrow(run, f"key {files.schema[key].dataType.simpleString()}, said long")
    held = files.where((F.col("section") == code + 1)).groupBy(F.col(key).alias("key")).agg(F.sum(F.length("bytes")).alias("held"))
    bad = said.join(held, "key", "full").where("not (coalesce(held, 0) <=> said)").head()
    if bad:
        raise ContainerError(f"{section} of {bad.key}: {bad.held} bytes, not {bad.said}")


def unpacked(files: DataFrame, section: str, key: str) -> DataFrame:
    """Rows of one section of containers (key, bytes, or their parts), with key. Faces also have edge_ids, block and level."""
    ship(files.sparkSession)
    dtype = {"node": NODE, "edge": EDGE, "face": FACE}.get(section) or COUNTED[section][0]
    kind = {"<i4": "int", "<f8": "double"}
    extra = ", edge_ids array<int>, block int, level int" if section == "face" else ""
    fields = ", ".join(f"{n} {kind[dtype[n].str]}" for n in dtype.names)

    def columns(rows: np.ndarray, value: pa.Scalar, edge_ids: list, blocks: np.ndarray | None, levels: np.ndarray | None) -> dict[str, pa.Array]:
        out = {n: pa.array(np.ascontiguousarray(rows[n])) for n in dtype.names}
        out["key"] = pa.array([value.as_py()] * len(rows), value.type)
        if section == "face":
            out["edge_ids"] = pa.array([list(map(int, x)) for x in edge_ids], pa.list_(pa.int32()))
            out["block"] = pa.array(np.ones(len(rows), np.int32) if blocks is None else blocks.astype(np.int32))
            out["level"] = pa.nulls(len(rows), pa.int32()) if levels is None else pa.array(levels.astype(np.int32))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch.column(1).to_pylist()):
                got = decode(bytes(data))
                yield pa.RecordBatch.from_pydict(columns(got[section], batch.column(0)[i], got["edge_ids"], got["blocks"], got["levels"] and got["levels"][0]))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, data in zip(batch.column(0), batch.column(1), strict=True):
                yield pa.RecordBatch.from_pydict(columns(np.frombuffer(data.as_py(), dtype), value, [], None, None))

    def together(table: pa.Table) -> pa.Table:
        raw = dict(zip(table.column("section").to_pylist(), table.column("bytes").to_pylist(), strict=True))
        if BLOCKS not in raw:
            raise ContainerError("blocks without faces, or faces without blocks")
        heads, ids = decode_faces(raw[SECTIONS.index("face") + 1], len(raw[BLOCKS]) // 4)
        return pa.table(columns(heads, table.column("key")[0], ids, np.frombuffer(raw[BLOCKS], "<i4"), np.frombuffer(raw[LEVELS], "<i4") if LEVELS in raw else None))

    key_type = files.schema[key].dataType.simpleString()
    if "section" in files.columns:
        checked(files, section, key)
        code = SECTIONS.index(section) + 1
        mine = files.where((F.col("part") > LEAD) & F.col("section").isin(code, *([BLOCKS, LEVELS] if section == "face" else []))).select(F.col(key).alias("key"), "section", "part", "bytes")
        schema = f"{fields}, key {key_type}{extra}"
        if section == "face":
            return mine.groupBy("key", "part").applyInArrow(together, schema).withColumnRenamed("key", key)
        few = mine.repartition(mine.count() // TASK_PARTS + 1, "key", "part")  # a batch is what a task has, up to 64 MB
        return few.select("key", "bytes").mapInArrow(some, schema).withColumnRenamed("key", key)
    return files.select(F.col(key).alias("key"), "bytes").mapInArrow(run, f"{fields}, key {key_type}{extra}").withColumnRenamed("key", key)
