"""Connected components of a link table, by star contraction on DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, drop_cut, ship


def local_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each one's component) of some links, by min-propagation with pointer jumping."""
    nodes, pos = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = pos[: len(a)], pos[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while not np.array_equal(nxt := label[label], label):
            label = nxt
        if np.array_equal(before, label):
            return nodes, nodes[label]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition, in bounded pieces, the links become (node, smallest node) without loops."""
    held_a, held_b, n = [], [], 0

    def flush() -> pa.RecordBatch:
        nodes, label = local_labels(np.concatenate(held_a), np.concatenate(held_b))
        keep = nodes != label
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(label[keep])], names=["a", "b"])

    for batch in batches:
        held_a.append(batch.column(0).to_numpy())
        held_b.append(batch.column(1).to_numpy())
        n += batch.num_rows
        if n > 2_000_000:
            yield (out := flush())
            held_a, held_b = [out.column(0).to_numpy()], [out.column(1).to_numpy()]
            n = out.num_rows
            if n > 1_000_000:
                held_a, held_b, n = [], [], 0
    if n:
        yield flush()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every id in a link to another id, the smallest id that links reach.

    Ids are long; links with a null end, loops and repeats are harmless. Each round first contracts the links that share
    a partition, then hangs every node's neighbours onto its smallest one (larger neighbours, then smaller ones); the
    links of a round go to the shared folder, and rounds end when none changes. Hot nodes are split by the engine's skew
    join and their minimum is taken before the shuffle.
    """
    spark = links.sparkSession
    ship(spark)
    edges = cut(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b").mapInArrow(_forest, "a long, b long"))
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # every link now points down; hang a node's smaller neighbours onto the smallest
        large = large.unionByName(low.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        down = cut(large)
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct().mapInArrow(_forest, "a long, b long").distinct())
        now = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"), F.sum(F.xxhash64("b").cast("decimal(38,0)")).alias("s")).collect()[0]
        drop_cut(down)
        drop_cut(edges)
        if (now.n, now.h, now.s) == mark or not now.n:
            return nxt.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(nxt.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        mark, edges = (now.n, now.h, now.s), nxt
