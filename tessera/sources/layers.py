"""Vector layers as tables of coordinate arrays: polygons with holes, lines, their reading, filtering and clipping.

Polygons are rows with parts array<struct<ring, holes>>; a ring is array<struct<x,y>> without its closing point. Layers
are Parquet tables of that shape, or CSV files with a wkt column. All are in one metric system; another is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.sources.csvs import exists

POINTS = "array<struct<x:double,y:double>>"
PARTS = f"array<struct<ring:{POINTS},holes:array<{POINTS}>>>"
_NUMBER = re.compile(r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?")


class LayerError(ValueError):
    """A layer is missing, empty, not metric or of another kind of geometry."""


def points_of(text: str) -> list[dict[str, float]]:
    out = []
    for pair in text.split(","):
        x, y = (float(v) for v in _NUMBER.findall(pair)[:2])
        out.append({"x": x, "y": y})
    return out


def parse_wkt(text: str | None) -> tuple[str, list]:
    """(kind, parts) of POLYGON, MULTIPOLYGON, LINESTRING and MULTILINESTRING; EMPTY has no parts."""
    if text is None or not text.strip():
        return "EMPTY", []
    kind, _, rest = text.strip().partition("(")
    kind = kind.strip().upper().split()[0] if kind.strip() else ""
    if "EMPTY" in text.upper():
        return kind, []
    if kind not in ("POLYGON", "MULTIPOLYGON", "LINESTRING", "MULTILINESTRING"):
        return kind, []
    rings = [points_of(r) for r in re.findall(r"\(([^()]*)\)", "(" + rest)]
    if kind in ("LINESTRING", "MULTILINESTRING"):
        return kind, rings
    open_ = [r[:-1] if len(r) > 1 and r[0] == r[-1] else r for r in rings]
    groups = [len(re.findall(r"\([^()]*\)", g)) for g in re.findall(r"\((?:\s*\([^()]*\)\s*,?)+\)", rest)] if kind == "MULTIPOLYGON" else [len(open_)]
    parts, at = [], 0
    for n in groups:
        parts.append({"ring": open_[at], "holes": open_[at + 1 : at + n]})
        at += n
    return kind, parts


def from_wkt(df: DataFrame, column: str = "wkt") -> DataFrame:
    """df with geometry_kind, parts (polygons) and lines (arrays of points) from a text column."""
    ship(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse_wkt(v) for v in pdf["w"]]
            yield pd.DataFrame({"w": pdf["w"], "geometry_kind": [k for k, _ in got], "parts": [p if "POLYGON" in k else None for k, p in got], "lines": [p if "LINE" in k else None for k, p in got]})

    seen = df.select(F.col(column).alias("w")).where("w is not null").distinct().mapInPandas(run, f"w string, geometry_kind string, parts {PARTS}, lines array<{POINTS}>")
    return df.join(seen, F.col(column) == F.col("w"), "left").drop("w")


def ring_area(ring: Column) -> Column:
    """Signed area; positive for counter-clockwise rings."""
    n = F.size(ring)
    turned = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.aggregate(F.zip_with(ring, turned, lambda p, q: p["x"] * q["y"] - p["y"] * q["x"]), F.lit(0.0), lambda a, v: a + v) / 2


def part_area(part: Column) -> Column:
    return F.abs(ring_area(part["ring"])) - F.aggregate(F.transform(part["holes"], lambda h: F.abs(ring_area(h))), F.lit(0.0), lambda a, v: a + v)


def line_length(pts: Column) -> Column:
    n = F.size(pts)
    steps = F.zip_with(F.slice(pts, 1, F.greatest(n - 1, F.lit(0))), F.slice(pts, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))
    return F.aggregate(steps, F.lit(0.0), lambda a, v: a + v)


def check_metric(epsg: int | None, geographic: frozenset[int] = frozenset({4326, 4612, 4979, 6668})) -> None:
    """An error for a system that is unknown or in degrees."""
    if epsg is None or epsg in geographic:
        raise LayerError(f"EPSG {epsg} isn't a metric system")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer's rows in file order (``at``), from Parquet or from a CSV with a wkt column."""
    if not exists(spark, path):
        raise LayerError(f"no such layer: {path}")
    if path.rstrip("/").endswith(".csv"):
        return from_wkt(spark.read.option("header", True).option("quote", '"').csv(path)).withColumn("at", F.monotonically_increasing_id())
    t = spark.read.parquet(path)
    return t if "at" in t.columns else t.withColumn("at", F.monotonically_increasing_id())


def polygons(layer: DataFrame) -> DataFrame:
    """A row for each part: at, part, ring, holes and the row's other columns; empty geometries go, other kinds are errors."""
    if "geometry_kind" in layer.columns:
        wrong = F.raise_error(F.concat(F.lit("not a polygon: "), F.col("geometry_kind"))).cast(PARTS)
        layer = layer.withColumn("parts", F.when(F.col("geometry_kind").isin("POLYGON", "MULTIPOLYGON", "EMPTY") | F.col("geometry_kind").isNull(), F.col("parts")).otherwise(wrong))
    rest = [c for c in layer.columns if c not in ("at", "parts", "lines", "geometry_kind", "part", "p")]
    return layer.where("size(parts) > 0").select("at", F.posexplode("parts").alias("part", "p"), *rest).select("at", "part", "p.ring", "p.holes", *rest)


def domain(layer: DataFrame, least_area: float, only: list[int] | None = None) -> DataFrame:
    """polygon (from 0 in file order), ring, holes, area of the parts of at least least_area; only those numbered in ``only``.

    Nothing left, or a number that isn't there, is an error.
    """
    big = polygons(layer).withColumn("area", part_area(F.struct("ring", "holes"))).where(F.col("area") >= least_area)
    from tessera.operators.topology import dense_ids

    found = dense_ids(big.select("at", "part", "ring", "holes", "area"), ["at", "part"], "n").withColumn("polygon", F.col("n") - 1).drop("n")
    if only is not None:
        found = found.join(F.broadcast(layer.sparkSession.createDataFrame([(i,) for i in only], "polygon long")), "polygon")
    kept = found.count()
    if not kept or (only is not None and kept != len(set(only))):
        raise LayerError("no polygon of the domain" if not kept else f"polygons {only} aren't all there")
    return found.select("polygon", "ring", "holes", "area")


def domain_indices(layer: DataFrame, least_area: float) -> list[int]:
    """0..n-1 of the parts that are large enough."""
    return list(range(polygons(layer).where(part_area(F.struct("ring", "holes")) >= least_area).count()))


def flat_lines(layer: DataFrame) -> DataFrame:
    """A row for each line of two points or more: at, part, pts and the row's other columns."""
    rest = [c for c in layer.columns if c not in ("at", "lines", "parts", "geometry_kind", "part", "pts")]
    return layer.where("size(lines) > 0").select("at", F.posexplode("lines").alias("part", "pts"), *rest).where(F.size("pts") > 1)


def line_layers(spark: SparkSession, paths: dict[str, str | None], optional: bool = False) -> DataFrame | None:
    """layer, line, pts of named line layers, numbered over all; without a path a layer is left out.

    A missing file is an error, or left out too if optional.
    """
    found = None
    for name, path in paths.items():
        if path is None or (optional and not exists(spark, path)):
            continue
        rows = flat_lines(read_layer(spark, path)).select(F.lit(name).alias("layer"), "at", "part", "pts")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return None
    from tessera.operators.topology import dense_ids

    return dense_ids(found, ["layer", "at", "part"], "line").select("layer", "line", "pts")


def merged_layers(layers: list[DataFrame]) -> DataFrame:
    """Rows of several layer tables, by name; a column that one lacks is null there."""
    out = layers[0]
    for t in layers[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def in_box(layer: DataFrame, box: tuple[float, float, float, float], pad: float) -> DataFrame:
    """Rows (bx0, by0, bx1, by1) that meet a padded box: plain comparisons, which reach a Parquet scan's statistics."""
    x0, y0, x1, y1 = box
    return layer.where((F.col("bx1") >= x0 - pad) & (F.col("bx0") <= x1 + pad) & (F.col("by1") >= y0 - pad) & (F.col("by0") <= y1 + pad))


def find_column(columns: list[str], preferred: str, aliases: tuple[str, ...], needed: str | None = None) -> str | None:
    """The first of preferred and aliases among columns, exactly or in another case; an error if it is needed and absent."""
    by_case = {c.lower(): c for c in reversed(columns)}
    for name in (preferred, *aliases):
        if name in columns or name.lower() in by_case:
            return name if name in columns else by_case[name.lower()]
    if needed:
        raise LayerError(f"no column for {needed} among {columns}")
    return None


def largest_part(layer: DataFrame) -> DataFrame:
    """at and the largest polygon of each row: ring, holes, area."""
    parts = polygons(layer).withColumn("area", part_area(F.struct("ring", "holes")))
    return parts.groupBy("at").agg(F.max_by(F.struct("ring", "holes", "area"), F.struct("area", F.negative("part"))).alias("p")).select("at", "p.*")


def oriented(rings: DataFrame) -> DataFrame:
    """Outlines counter-clockwise, holes clockwise."""
    turn = lambda ring, want: F.when((ring_area(ring) < 0) if want else (ring_area(ring) > 0), F.reverse(ring)).otherwise(ring)
    return rings.withColumns({"ring": turn(F.col("ring"), True), "holes": F.transform("holes", lambda h: turn(h, False))})


def clipped_segments(segments: DataFrame, domain: DataFrame, cell: float) -> DataFrame:
    """The pieces of segments (line, i, ax, ay, bx, by) inside polygons (polygon, ring, holes): line, i, polygon, t0, t1 and ends.

    A segment is cut where it meets a ring's sides; a piece is inside if its middle is, by crossings counted to its right.
    Segments and sides meet through strips, so neither side of the join is a cross product.
    """
    rings = domain.select("polygon", F.explode(F.concat(F.array("ring"), F.col("holes"))).alias("r"))
    n = F.size("r")
    side = rings.select("polygon", F.explode(F.zip_with("r", F.concat(F.slice("r", 2, n - 1), F.slice("r", 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))).alias("s"))
    side = side.select("polygon", F.col("s.p.x").alias("px"), F.col("s.p.y").alias("py"), F.col("s.q.x").alias("qx"), F.col("s.q.y").alias("qy"))
    rows = lambda df, a, b: df.withColumn("gy", F.explode(F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))))
    seg = rows(segments, "ay", "by")
    c = F.col
    d = (c("bx") - c("ax")) * (c("qy") - c("py")) - (c("by") - c("ay")) * (c("qx") - c("px"))
    t = ((c("px") - c("ax")) * (c("qy") - c("py")) - (c("py") - c("ay")) * (c("qx") - c("px"))) / d
    u = ((c("px") - c("ax")) * (c("by") - c("ay")) - (c("py") - c("ay")) * (c("bx") - c("ax"))) / d
    met = seg.join(rows(side, "py", "qy"), "gy").where(d != 0).withColumns({"t": t, "u": u}).where("t > 0 and t < 1 and u >= 0 and u <= 1")
    cuts = met.groupBy("line", "i").agg(F.array_sort(F.collect_set("t")).alias("ts"))
    with_cuts = segments.join(cuts, ["line", "i"], "left").withColumn("ts", F.concat(F.array(F.lit(0.0)), F.coalesce("ts", F.array().cast("array<double>")), F.array(F.lit(1.0))))
    m = F.size("ts")
    piece = with_cuts.select("line", "i", "ax", "ay", "bx", "by", F.explode(F.zip_with(F.slice("ts", 1, m - 1), F.slice("ts", 2, m - 1), lambda a, b: F.struct(a.alias("t0"), b.alias("t1")))).alias("w")).select("line", "i", "ax", "ay", "bx", "by", "w.t0", "w.t1").where("t1 > t0")
    mid = (c("t0") + c("t1")) / 2
    at = piece.withColumns({"mx": c("ax") + mid * (c("bx") - c("ax")), "my": c("ay") + mid * (c("by") - c("ay"))}).withColumn("gy", F.floor(c("my") / cell))
    # a polygon's sides of a strip are one row, so crossings are counted where the two meet and only pieces inside go on
    x = F.struct(F.min(F.least("px", "qx")).alias("lo"), F.max(F.greatest("px", "qx")).alias("hi"))
    strips = rows(side, "py", "qy").groupBy("gy", "polygon").agg(x.alias("x"), F.collect_list(F.struct("px", "py", "qx", "qy")).alias("sides"))
    right = lambda s: ((s["py"] > c("my")) != (s["qy"] > c("my"))) & (c("mx") < (s["qx"] - s["px"]) * (c("my") - s["py"]) / (s["qy"] - s["py"]) + s["px"])
    near = at.join(strips, "gy").where((c("mx") >= c("x.lo")) & (c("mx") <= c("x.hi")))  # rings are closed: to their left crossings are even
    inside = near.where(F.size(F.filter("sides", right)) % 2 == 1)
    end = lambda k, z: (c(f"a{z}") + c(k) * (c(f"b{z}") - c(f"a{z}"))).alias
    return inside.select("line", "i", "polygon", "t0", "t1", end("t0", "x")("x0"), end("t0", "y")("y0"), end("t1", "x")("x1"), end("t1", "y")("y1"))


def features(layer: DataFrame, aliases: dict[str, tuple[str, ...]], kind: int | None = None, default_mode: str = "absolute") -> DataFrame:
    """Special-edge features of a line layer: feature, kind, z_mode, zc, H, B, z_road, fr, cover, qgroup and the segment's ends.

    Columns are found by name or alias; blank and non-numeric values are null. Rows of an unknown kind, or of none, go;
    ``kind`` fixes it for the whole layer. Lines are split at their vertices.
    """
    from tessera.operators import special
    from tessera.operators.topology import dense_ids

    lines = flat_lines(layer)
    text = lambda name: F.col(f"`{c}`").cast("string") if (c := find_column(lines.columns, name, aliases.get(name, ()))) else F.lit(None).cast("string")
    t = lines.select("at", "part", "pts", text("kind").alias("kind_text"), text("z_mode").alias("mode_text"), *[special.number(text(n)).alias(n) for n in ("zc", "H", "B", "z_road", "fr", "cover")], special.whole_number(text("qgroup")).alias("qgroup"))
    t = t.withColumn("kind", F.lit(kind)) if kind is not None else special.known_kinds(t, "kind_text")
    t = special.z_modes(t, "mode_text", default_mode)
    n = F.size("pts")
    pairs = F.zip_with(F.slice("pts", 1, n - 1), F.slice("pts", 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    flat = t.select("*", F.posexplode(pairs).alias("i", "s")).select("*", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by")).where("ax <> bx or ay <> by")
    return dense_ids(flat.drop("s", "pts", "kind_text", "mode_text"), ["at", "part", "i"], "feature")


def road_lines(lines: DataFrame, classes: list[str], least_length: float, kind: str = "highway", truthy: tuple[str, ...] = ("T", "TRUE", "YES", "1")) -> DataFrame:
    """Lines of some road classes that are long enough and neither bridges nor tunnels."""
    flag = lambda c: F.coalesce(F.upper(F.trim(F.col(c).cast("string"))).isin(*truthy), F.lit(False)) if c in lines.columns else F.lit(False)
    return lines.where(F.col(kind).isin(classes) & (line_length(F.col("pts")) >= least_length) & ~flag("bridge") & ~flag("tunnel"))


def longest(lines: DataFrame, k: int) -> DataFrame:
    """The k longest lines, ties to the smaller number."""
    return lines.withColumn("length", line_length(F.col("pts"))).orderBy(F.desc("length"), "line").limit(k)


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 within their block, in the order of ``by``."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy("block").orderBy(*by)) - 1)
