"""Exact top-k inner-product search (operator 1): a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards by a hash and each shard's task builds one ball tree. Queries travel in blocks. A block first
meets one shard, which gives every query a k-th score; that score goes with it to the other shards, and inside a task it
goes on from shard to shard, so that most balls, and often whole trees, end at their bound: a ball of centre c and
radius r holds no score above <q, c> + |q| r. Children are visited in the order of that bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, ship
from tessera.llm.memory import tidied

LEAF = 128


def vector_matrix(col: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions and values of the usable vectors: not null, not empty, all components finite."""
    rows, out = [], []
    for i, v in enumerate(col.to_numpy(zero_copy_only=False)):
        if v is None or len(v) == 0:
            continue
        v = np.asarray(v)
        v = v.astype(np.float64) if v.dtype != object else np.array([np.nan if x is None else x for x in v], np.float64)
        if np.isfinite(v).all():
            rows.append(i)
            out.append(v)
    return np.array(rows, np.int64), out


def precise(x: np.ndarray) -> np.ndarray:
    """x as it is if inner products of such vectors are exact in doubles, else in the extended precision of 64 bits.

    Wide values take the slower arithmetic, whose exponents don't overflow on products of doubles.
    """
    top = float(np.abs(x).max(initial=0.0))
    narrow = top < 2.0**26 and top * top * max(1, x.shape[1]) < 2.0**53
    return x if narrow else x.astype(np.longdouble)


def as_long(score: np.ndarray) -> np.ndarray:
    """Scores as longs; those beyond a long become its ends."""
    if score.dtype == np.float64:
        return score.astype(np.int64)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    out = np.where(score > 0, high, low)
    inside = np.abs(score) < 2.0**63
    out[inside] = score[inside].astype(np.int64)
    return out


class BallTree:
    """Nodes in preorder; a leaf's vectors are rows lo..hi of points, which are sorted by node."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        points = precise(points)
        order = np.lexsort((ids,))
        self.ids, self.points = ids[order], points[order]
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.left: list[int] = []
        self.right: list[int] = []
        centres, radii = [], []
        perm = np.arange(len(ids))
        stack = [(0, len(ids), -1, False)]
        while stack:
            lo, hi, parent, is_right = stack.pop()
            at = len(self.lo)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = at
            part = self.points[perm[lo:hi]]
            centre = part.mean(axis=0) if hi > lo else np.zeros(points.shape[1])
            spread = np.sqrt(((part - centre) ** 2).sum(axis=1)) if hi > lo else np.zeros(1)
            self.lo.append(lo)
            self.hi.append(hi)
            self.left.append(-1)
            self.right.append(-1)
            centres.append(centre)
            radii.append(spread.max() * (1 + 1e-9))
            if hi - lo > LEAF and spread.max() > 0:
                a = part[np.argmax(spread)]
                b = part[np.argmax(((part - a) ** 2).sum(axis=1))]
                side = part @ (b - a)
                perm[lo:hi] = perm[lo:hi][np.argsort(side, kind="stable")]
                mid = (lo + hi) // 2
                stack += [(mid, hi, at, True), (lo, mid, at, False)]
        self.ids, self.points = self.ids[perm], self.points[perm]
        self.centres, self.radii = np.array(centres), np.array(radii)


class TopK:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, k: int, least: np.ndarray | None = None):
        queries = precise(queries)
        self.q, self.own, self.k = queries, own, k
        self.norm = np.sqrt((queries**2).sum(axis=1))
        n = len(queries)
        self.score = np.full((n, k), -np.inf, queries.dtype)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.least = np.full(n, -np.inf, queries.dtype) if least is None else least.astype(queries.dtype)

    def bound(self, rows: np.ndarray, tree: BallTree, node: int) -> np.ndarray:
        dots = self.q[rows] @ tree.centres[node]
        return dots + self.norm[rows] * tree.radii[node] + 1e-9 * (np.abs(dots) + self.norm[rows] * np.sqrt((tree.centres[node] ** 2).sum())) + 1e-6

    def widen(self, dtype: np.dtype) -> None:
        """Goes on in the tree's precision if that is the wider one."""
        if dtype != self.score.dtype and dtype == np.longdouble:
            self.q, self.norm, self.score, self.least = (x.astype(dtype) for x in (self.q, self.norm, self.score, self.least))

    def visit(self, rows: np.ndarray, tree: BallTree, node: int = 0) -> None:
        self.widen(tree.points.dtype)
        rows = rows[self.bound(rows, tree, node) >= self.least[rows]]
        if not len(rows):
            return
        if tree.left[node] < 0:
            self.scan(rows, tree, node)
            return
        a, b = tree.left[node], tree.right[node]
        first = self.bound(rows, tree, a) >= self.bound(rows, tree, b)
        for part, one, other in ((rows[first], a, b), (rows[~first], b, a)):
            if len(part):
                self.visit(part, tree, one)
                self.visit(part, tree, other)

    def scan(self, rows: np.ndarray, tree: BallTree, node: int) -> None:
        lo, hi = tree.lo[node], tree.hi[node]
        for at in range(lo, hi, 4096):  # a leaf of equal vectors may be large
            ids = tree.ids[at : min(hi, at + 4096)]
            s = self.q[rows] @ tree.points[at : min(hi, at + 4096)].T
            if s.dtype != np.float64:
                s = np.clip(s, -np.longdouble(2**63), np.longdouble(2**63 - 1))
            s[ids[None, :] == self.own[rows][:, None]] = -np.inf
            score = np.concatenate([self.score[rows], s], axis=1)
            both = np.concatenate([self.id[rows], np.broadcast_to(ids, s.shape)], axis=1)
            order = np.lexsort((both, -score), axis=1)[:, : self.k]
            self.score[rows], self.id[rows] = np.take_along_axis(score, order, 1), np.take_along_axis(both, order, 1)
            self.least[rows] = np.maximum(self.least[rows], self.score[rows][:, -1])


def pack(ids: list, rows: list[np.ndarray]) -> tuple[bytes, bytes]:
    return np.array(ids, np.int64).tobytes(), np.array(rows, np.float64).tobytes()


def exact_top_k(vectors: DataFrame, *, k: int = 5, query_where: str, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, shard_rows: int = 16_384, block_rows: int = 512, shards_per_task: int = 8) -> DataFrame:
    """Each query's k best integer inner products among all rows but its own: (query_id, rank, vec_id, score).

    Components become floor(scale * x), x as double. Rows for which query_where holds are the queries. Rows with a null
    id or whose vector is null, empty or holds a null or non-finite component take no part; vectors of different lengths
    don't meet. Rows of the same id are one vector's copies: none of them is a candidate for that id's query, and equal
    (id, vector) rows count once. Scores are exact as long as products' absolute values sum up to less than 2**63; a
    score beyond a long is given as the nearer end of a long, and such scores tie.
    """
    spark = vectors.sparkSession
    ship(spark)

    @tidied
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vs = vector_matrix(batch.column(1))
            largest = np.finfo(np.float64).max
            ints = [np.clip(np.floor(scale * v), -largest, largest) for v in vs]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([x.tobytes() for x in ints], pa.binary()), batch.column(2).take(pa.array(rows))], names=["id", "v", "is_query"])

    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.expr(query_where).alias("is_query")).where("id is not null")
    usable = cut(plain.mapInArrow(clean, "id long, v binary, is_query boolean").dropDuplicates(["id", "v"]))
    sizes = usable.agg(F.count("*").alias("n"), F.sum(F.col("is_query").cast("int")).alias("q")).collect()[0]
    shards = max(1, -(-sizes.n // shard_rows))
    blocks = max(1, -(-(sizes.q or 0) // block_rows))

    @tidied
    def packer(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        return pd.DataFrame({"part": rows["part"].iloc[:1], "dim": rows["dim"].iloc[:1], "ids": [rows["id"].to_numpy(np.int64).tobytes()], "vs": [b"".join(rows["v"])]})

    def packed(df: DataFrame, n: int) -> DataFrame:
        dealt = df.select(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(n)).cast("int").alias("part"), F.length("v").alias("dim"), "id", "v")
        return dealt.groupBy("part", "dim").applyInPandas(packer, "part int, dim int, ids binary, vs binary")

    trees = cut(packed(usable, shards))
    asked = cut(packed(usable.where("is_query"), blocks))
    found = "block int, dim int, query_id long, vec_id long, score long"

    def search(start: bool):
        @tidied
        def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            grown = []
            for r in right.sort_values("part").itertuples():
                ids = np.frombuffer(r.ids, np.int64)
                grown.append((r.part, BallTree(ids, np.frombuffer(r.vs, np.float64).reshape(len(ids), -1))))
            for r in left.sort_values("part").itertuples():
                ids = np.frombuffer(r.ids, np.int64)
                q = np.frombuffer(r.vs, np.float64).reshape(len(ids), -1)
                best = TopK(q, ids, k, None if start else np.frombuffer(r.least, np.float64))
                for part, tree in grown:
                    if start or part != r.home:
                        best.visit(np.arange(len(ids)), tree)
                n, j = np.nonzero(best.score > -np.inf)
                out.append(pd.DataFrame({"block": r.part, "dim": r.dim, "query_id": ids[n], "vec_id": best.id[n, j], "score": as_long(best.score[n, j])}))
            return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in found.split(", ")}).astype({"block": "int32", "dim": "int32", "query_id": "int64", "vec_id": "int64", "score": "int64"})

        return run

    home = F.pmod("part", F.lit(shards))
    first = asked.withColumn("home", home).groupBy("home", "dim").cogroup(trees.withColumn("home", F.col("part")).groupBy("home", "dim")).applyInPandas(search(True), found)
    first = cut(first)
    if shards == 1:
        every = first
    else:
        # a k-th score is known only for queries that already have k results
        kth = first.groupBy("block", "dim", "query_id").agg(F.min("score").alias("s"), F.count("*").alias("n")).select("block", "dim", "query_id", F.when(F.col("n") >= k, F.col("s")).alias("s"))

        @tidied
        def bounds(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            known = dict(zip(right["query_id"], right["s"], strict=True))
            for r in left.itertuples():
                s = np.array([known.get(i, np.nan) for i in np.frombuffer(r.ids, np.int64).tolist()], np.float64)
                least = np.nextafter(np.where(np.isnan(s), -np.inf, s), -np.inf)  # a long's double may lie above it
                out.append((r.part, r.dim, r.ids, r.vs, least.tobytes()))
            return pd.DataFrame(out, columns=["part", "dim", "ids", "vs", "least"])

        ready = asked.groupBy("part", "dim").cogroup(kth.groupBy("block", "dim")).applyInPandas(bounds, "part int, dim int, ids binary, vs binary, least binary")
        groups = -(-shards // shards_per_task)
        spread = ready.withColumn("home", home).withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("blk", F.pmod("part", F.lit(max(1, 64 // groups))))
        copies = trees.withColumn("grp", (F.col("part") / shards_per_task).cast("int")).withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(min(blocks, max(1, 64 // groups)) - 1))))
        rest = spread.groupBy("grp", "dim", "blk").cogroup(copies.groupBy("grp", "dim", "blk")).applyInPandas(search(False), found)
        every = first.unionByName(rest)
    best = every.select("query_id", "vec_id", "score").dropDuplicates(["query_id", "vec_id", "score"])
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
