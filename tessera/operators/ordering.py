"""Renumbering faces, edges, vertices and what hangs on them, and how local an order is."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.cluster import cut, partitions, ship
from tessera.components import connected_components
from tessera.operators.topology import dense_ids

#: Faces that a kernel of bandwidth_order holds, as long as components are smaller.
FACES_PER_TASK = 100_000


def vertex_order(edges: DataFrame) -> DataFrame:
    """vertex, new (from 1): by the first face that touches it, then by number. edges: v1, v2, face_left, face_right."""
    face = F.least(F.when(F.col("face_left") > 0, F.col("face_left")), F.when(F.col("face_right") > 0, F.col("face_right")))
    first = edges.select(F.explode(F.array("v1", "v2")).alias("vertex"), face.alias("f")).groupBy("vertex").agg(F.min("f").alias("f"))
    return dense_ids(first, ["f", "vertex"], "new").select("vertex", "new")


def edge_order(edges: DataFrame) -> DataFrame:
    """ln, new (from 1): by smaller face, larger face (0 on the boundary), number."""
    outer = F.col("face_right") == 0
    lo = F.when(outer, F.col("face_left")).otherwise(F.least("face_left", "face_right"))
    hi = F.when(outer, 0).otherwise(F.greatest("face_left", "face_right"))
    return dense_ids(edges.select("ln", lo.alias("lo"), hi.alias("hi")), ["lo", "hi", "ln"], "new").select("ln", "new")


def remapped(df: DataFrame, column: str, order: DataFrame, key: str) -> DataFrame:
    """df with positive numbers in column replaced by order's (key, new); 0 stays, unknown numbers are an error."""
    t = df.join(order.select(F.col(key).alias(column), F.col("new").alias("new__")), column, "left")
    lost = F.when(F.col(column) <= 0, F.col(column)).otherwise(F.raise_error(F.concat(F.lit(f"{column} out of range: "), F.col(column).cast("string"))).cast("long"))
    return t.withColumn(column, F.coalesce("new__", lost)).drop("new__")


def locality(edges: DataFrame) -> DataFrame:
    """One row: mean distance of an inner edge's faces, and mean step of the left face from one inner edge to the next.

    Inner edges are followed by ln. The step is taken within ranges of 100,000 edges and between neighbouring ranges, so
    that no task sees all of them.
    """
    inner = edges.where("face_left > 0 and face_right > 0").select("ln", "face_left", "face_right").withColumn("chunk", F.floor(F.col("ln") / 100000))
    w = Window.partitionBy("chunk").orderBy("ln")
    inside = inner.withColumn("step", F.abs(F.col("face_left") - F.lag("face_left").over(w))).groupBy("chunk").agg(F.sum("step").alias("steps"), F.count("step").alias("n"), F.sum(F.abs(F.col("face_left") - F.col("face_right"))).alias("gaps"), F.count("*").alias("m"), F.min_by("face_left", "ln").alias("first"), F.max_by("face_left", "ln").alias("last"))
    across = F.abs(F.col("first") - F.lag("last").over(Window.orderBy("chunk")))
    t = inside.withColumn("across", across)
    return t.agg((F.sum("gaps") / F.sum("m")).alias("face_distance"), ((F.sum("steps") + F.coalesce(F.sum("across"), F.lit(0))) / (F.sum("n") + F.count("across"))).alias("left_step"))


def components(pairs: DataFrame, faces: DataFrame) -> DataFrame:
    """face, component: the smallest face that pairs (e0, e1) reach, itself included."""
    linked = connected_components(pairs, "e0", "e1").withColumnRenamed("id", "face")
    return faces.select("face").join(linked, "face", "left").select("face", F.coalesce("component", "face").alias("component"))


def bandwidth_order(pairs: DataFrame, faces: DataFrame, by: str = "component") -> DataFrame:
    """face, new (from 1): reverse Cuthill-McKee inside each component of face pairs (e0, e1).

    Breadth-first orders are sequential, so each component is ordered as a whole; a kernel holds many components, dealt
    by hash, and takes them one after another. faces has face and ``by``. Components follow one another by their smallest
    face, the whole order is then reversed.
    """
    ship(pairs.sparkSession)
    faces = cut(faces.select("face", F.col(by).alias("part")))
    named = pairs.join(faces.select(F.col("face").alias("e0"), "part"), "e0").select(F.col("part").alias("of"), "e0", "e1")
    tasks = max(partitions(pairs.sparkSession), faces.count() // FACES_PER_TASK)
    task = lambda c: F.pmod(F.xxhash64(c), F.lit(tasks))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, right = left.sort_values(["part", "face"]), right.sort_values("of")
        face, e0, e1 = left["face"].to_numpy(), right["e0"].to_numpy(), right["e1"].to_numpy()
        parts, start = np.unique(left["part"].to_numpy(), return_index=True)
        ends = np.append(start[1:], len(face))
        lo, hi = np.searchsorted(right["of"].to_numpy(), parts), np.searchsorted(right["of"].to_numpy(), parts, "right")
        order = np.empty_like(face)
        for a, b, p, q in zip(start.tolist(), ends.tolist(), lo.tolist(), hi.tolist(), strict=True):
            order[a:b] = cuthill_mckee(face[a:b].tolist(), list(zip(e0[p:q].tolist(), e1[p:q].tolist(), strict=True)))
        size = ends - start
        return pd.DataFrame({"first": np.repeat(face[start], size), "face": order, "pos": np.arange(len(face)) - np.repeat(start, size)})

    placed = faces.withColumn("task", task("part")).groupBy("task").cogroup(named.withColumn("task", task("of")).groupBy("task")).applyInPandas(run, "first long, face long, pos long")
    numbered = dense_ids(cut(placed), ["first", "pos"], "fwd", first=0)
    n = numbered.agg(F.count("*").alias("n"))
    return numbered.crossJoin(F.broadcast(n)).select("face", (F.col("n") - F.col("fwd")).alias("new"))


def cuthill_mckee(faces: list[int], pairs: list[tuple[int, int]]) -> list[int]:
    """Breadth-first order of one component from a face of the outermost level, neighbours by (degree, number)."""
    near: dict[int, set[int]] = {f: set() for f in faces}
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    rank = {f: (len(near[f]), f) for f in faces}

    def levels(start: int) -> list[list[int]]:
        seen, out = {start}, [[start]]
        while out[-1]:
            out.append([b for a in out[-1] for b in sorted(near[a], key=rank.get) if not (b in seen or seen.add(b))])
        return out[:-1]

    root = min(faces, key=rank.get)
    far = levels(root)
    tip = min(far[-1], key=rank.get)
    while len(nxt := levels(tip)) > len(far):
        root, far, tip = tip, nxt, min(nxt[-1], key=rank.get)
    return [f for level in levels(root) for f in level]


def permuted_series(rows: DataFrame, order: DataFrame) -> DataFrame:
    """A time series in long form (t, face, v) under new face numbers."""
    return remapped(rows, "face", order, "face")


def permuted_arrays(rows: DataFrame, new_to_old: list[int]) -> DataFrame:
    """A time series with one array of values a row (t, vals), values in the order new_to_old (from 0).

    A row of another width is an error.
    """
    # the order is one row of data that is sent out whole, not a literal for each face in the plan
    order = F.broadcast(rows.sparkSession.createDataFrame([(list(new_to_old),)], "order__ array<int>"))
    moved = F.transform("order__", lambda i: F.element_at("vals", i + 1))
    t = rows.crossJoin(order)
    return t.withColumn("vals", F.when(F.size("vals") == len(new_to_old), moved).otherwise(F.raise_error(F.lit("a row of another width")))).drop("order__")
