"""Embedding near-dedup (operator 8): inverted lists with product-quantised residuals, and exact reranking.

Vectors are normalised, so cosine >= c means a distance of at most d = sqrt(2 - 2c). Each vector belongs to the list of
its nearest coarse centre. If x of list a and y of list b are within d, the plane half way between the two centres is
crossed on the way: x's distance to it and y's add up to d at most, so one of them is within d / 2 of it. Each vector
therefore probes its own list and those whose plane is within d / 2, and every pair is met from at least one side: those
are sufficient probes. In a list the asymmetric distance from x to a member's code, less the member's own coding error,
is a lower bound of the true distance; members within d by that bound get an exact cosine in double precision. So
nothing is lost by lists or codes, whatever sample they were fitted on.

Lists are put together into groups of about ``block_rows`` members, lists larger than that are split into blocks. A vector
goes once to each group that holds a list it probes, in slices of about ``block_rows``, so neither side of a task grows.
Groups are dealt in rounds, and a round's rows leave the disk before the next: how often a vector is sent then costs
time, not disk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, cut_path, drop_cut, release, ship
from tessera.components import connected_components, local_labels
from tessera.llm.memory import tidied
from tessera.llm.search import vector_matrix
from tessera.llm.text import mix64, ragged


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = n > 0
        centres[full] = sums[full] / n[full, None]
    return np.unique(centres, axis=0)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x**2).sum(1)[:, None] + (c**2).sum(1)[None, :] - 2 * x @ c.T)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


class Quantiser:
    """Coarse centres and, for residuals cut into subspaces, a codebook each."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = 8, codes: int = 64):
        self.centres = k_means(sample, min(lists, len(sample)))
        rest = sample - self.centres[nearest(sample, self.centres)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        self.books = [k_means(rest[:, c], min(codes, len(rest))) for c in self.cuts]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, coding error) of each vector."""
        home = nearest(x, self.centres)
        rest = x - self.centres[home]
        codes = np.stack([nearest(rest[:, c], b) for c, b in zip(self.cuts, self.books, strict=True)], axis=1)
        back = np.concatenate([b[codes[:, s]] for s, b in enumerate(self.books)], axis=1)
        return home, codes.astype(np.uint8), np.sqrt(((rest - back) ** 2).sum(1))

    def probes(self, x: np.ndarray, reach: float) -> np.ndarray:
        """Which lists may hold a vector within reach, as their planes are: a row per vector."""
        d2 = squared(x, self.centres)
        home = d2.argmin(1)
        apart = np.sqrt(squared(self.centres, self.centres))[home]
        gap = (d2 - d2[np.arange(len(x)), home][:, None]) / np.maximum(2 * apart, 1e-12)
        return (gap <= reach + 1e-7) | (apart == 0)

    def asymmetric(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        rest = x - self.centres[at]
        return sum(squared(rest[:, c], b)[:, codes[:, s]] for s, (c, b) in enumerate(zip(self.cuts, self.books, strict=True)))


class Side:
    """One side of a comparison: vectors with their ids, weights, lists, codes, coding errors and probed lists."""

    def __init__(self, table: pa.Table, dim: int):
        self.ids, self.weight, self.home = (table.column(c).to_numpy() for c in ("rep", "weight", "list"))
        self.v = np.frombuffer(ragged(table.column("v"))[0].tobytes(), np.float64).reshape(-1, dim)
        probes = table.column("probes").combine_chunks()
        size = probes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.row, self.probed = np.repeat(np.arange(len(size)), size), probes.flatten().to_numpy()
        codes = ragged(table.column("codes"))[0]
        self.codes = codes.reshape(len(size), -1) if len(size) and len(codes) else None
        self.error = table.column("error").to_numpy()


def compare(model: Quantiser, least: float, x: Side, y: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, labels, x's linked weight, y's linked weight) of the pairs of cosine >= least that x's probes find.

    nodes are rows of x and, from len(x.ids) on, of y; equal labels are linked. A pair counts for x; it counts for y
    too if y's probes don't find it.
    """
    reach = np.sqrt(2 - 2 * least)
    heads, tails, n, m = [], [], np.zeros(len(x.ids), np.int64), np.zeros(len(y.ids), np.int64)
    lists = np.int64(len(model.centres))
    asked = np.sort(y.row * lists + y.probed)
    members, probing = np.argsort(y.home, kind="stable"), np.argsort(x.probed, kind="stable")
    for at in np.unique(y.home):
        mine = members[slice(*np.searchsorted(y.home[members], [at, at + 1]))]
        rows = x.row[probing[slice(*np.searchsorted(x.probed[probing], [at, at + 1]))]]
        for i in range(0, len(rows), 256):
            part = rows[i : i + 256]
            near = model.asymmetric(x.v[part], at, y.codes[mine]) <= ((reach + y.error[mine] + 1e-7) ** 2)[None, :]
            if near.mean() > 0.05:
                r, c = np.nonzero(near & (x.v[part] @ y.v[mine].T >= least))
            else:
                r, c = np.nonzero(near)
                ok = np.einsum("ij,ij->i", x.v[part[r]], y.v[mine[c]]) >= least
                r, c = r[ok], c[ok]
            r, c = part[r], mine[c]
            other = x.ids[r] != y.ids[c]
            r, c = r[other], c[other]
            if not len(r):
                continue
            np.add.at(n, r, y.weight[c])
            key = c * lists + x.home[r]
            unasked = asked[np.minimum(np.searchsorted(asked, key), len(asked) - 1)] != key
            np.add.at(m, c[unasked], x.weight[r[unasked]])
            nodes, label = local_labels(r, c + len(x.ids))
            heads.append(nodes)
            tails.append(label)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(heads or none), np.concatenate(tails or none), n, m


def near_duplicates(vectors: DataFrame, *, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", list_rows: int = 256, most_lists: int = 16_384, sample_rows: int = 20_000, block_rows: int = 8192, round_rows: int = 1_000_000) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept).

    n_links counts the other rows with cosine >= least; component_id is the smallest id that such links reach, itself
    included. A vector that is null, empty, all zero or holds a null or non-finite component links with nothing; nor do
    vectors of different lengths. A null id has a null component and is kept. Equal vectors are compared once and count
    as often as they occur. Lists and codes are fitted on at most about ``sample_rows`` distinct vectors drawn by hash;
    all rows are indexed. Beyond list_rows * most_lists vectors the lists grow, and with them the work for each vector.
    A round deals ``round_rows`` rows, half the number of vectors if that is more, or one group.
    """
    spark = vectors.sparkSession
    ship(spark)

    @tidied
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vs = vector_matrix(batch.column(1))
            out: list[bytes | None] = [None] * batch.num_rows
            for r, v in zip(rows.tolist(), vs, strict=True):
                top = np.abs(v).max()
                if top > 0:
                    v = v / top
                    out[r] = (v / np.sqrt((v**2).sum())).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "v"])

    rows = cut(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).mapInArrow(clean, "id long, v binary"))
    groups = cut(rows.where("v is not null and id is not null").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("weight")))
    members = cut(rows.where("v is not null and id is not null").join(groups, "v").select("id", "rep", "weight"))
    alone = cut(rows.where("v is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    drop_cut(rows)
    release(spark)
    results = []
    dims = sorted(r.d for r in groups.select(F.length("v").alias("d")).distinct().collect())
    for dim in dims:
        results.append(_links(groups.where(F.length("v") == dim), dim // 8, least, list_rows, most_lists, sample_rows, block_rows, round_rows, groups if dim == dims[-1] else None))
    found = None
    for r in results:
        found = r if found is None else cut(found.unionByName(r))
    if found is None:
        return alone.withColumn("kept", F.lit(True))
    total = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    joined = connected_components(found).withColumnRenamed("id", "rep")
    linked = members.join(total, "rep", "left").join(joined, "rep", "left").select("id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _links(groups: DataFrame, dim: int, least: float, list_rows: int, most_lists: int, sample_rows: int, block_rows: int, round_rows: int, last: DataFrame | None) -> DataFrame:
    """(a, b, n): a's component is b's, as far as one comparison shows, and a links n more rows. last is dropped once read."""
    spark = groups.sparkSession
    count = groups.count()
    rate = min(1.0, sample_rows / max(count, 1))
    sample = groups.where(F.pmod(F.xxhash64(F.lit(9), "rep"), F.lit(1 << 20)) < rate * (1 << 20)).orderBy("rep").limit(2 * sample_rows).select("v").collect()
    if not sample:
        sample = groups.limit(1).collect()
    matrix = np.frombuffer(b"".join(bytes(r.v) for r in sample), np.float64).reshape(-1, dim)
    model = Quantiser(matrix, int(max(1, min(most_lists, count // list_rows))))
    shared = spark.sparkContext.broadcast(model)
    reach = float(np.sqrt(2 - 2 * least))
    lists = len(model.centres)

    @tidied
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = np.frombuffer(ragged(part.column(2))[0].tobytes(), np.float64).reshape(-1, dim)
                home, codes, error = model.encode(x)
                row, probed = np.nonzero(model.probes(x, reach / 2))  # the other half is the other vector's
                off = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
                probes = pa.ListArray.from_arrays(pa.array(off), pa.array(probed.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), probes], names=["rep", "weight", "v", "list", "codes", "error", "probes"])

    @tidied
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many vectors of a partition probe each list."""
        n = np.zeros(lists, np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy(), minlength=lists)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], names=["list", "n"])

    fields = "rep long, weight long, v binary, list int, codes binary, error double, probes array<int>"
    indexed = cut(groups.select("rep", "weight", "v").mapInArrow(index, fields))
    if last is not None:
        drop_cut(last)
    # a row per list, most_lists at most
    held = {r.list: r.n for r in indexed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    asking = {r.list: r.n for r in indexed.select("probes").mapInArrow(asked, "list int, n long").groupBy("list").agg(F.sum("n").alias("n")).collect()}
    first, blocks, slices, room, sizes = np.zeros(lists, np.int64), np.ones(lists, np.int64), [0], block_rows, [0]
    for at in range(lists):
        size = held.get(at, 0)
        blocks[at] = max(1, -(-size // block_rows))
        if size > room and room < block_rows:
            slices.append(0)
            sizes.append(0)
            room = block_rows
        first[at] = len(slices) - 1
        slices[-1] += asking.get(at, 0)
        sizes[-1] += -(-size // int(blocks[at]))
        slices += [asking.get(at, 0)] * int(blocks[at] - 1)
        sizes += [-(-size // int(blocks[at]))] * int(blocks[at] - 1)
        room = room - size if blocks[at] == 1 else 0
    asked_rows = np.minimum(count, np.array(slices, np.int64))
    parts = np.maximum(1, -(-asked_rows // block_rows))
    layout = spark.sparkContext.broadcast((first, blocks, parts))
    # rounds of groups: [starts[i], starts[i + 1])
    starts, dealt = [0], 0
    for at, n in enumerate((asked_rows + np.array(sizes, np.int64) * parts).tolist()):
        if dealt and dealt + n > max(round_rows, count // 2):
            starts.append(at)
            dealt = 0
        dealt += n
    starts.append(len(slices))

    def deal(batches: Iterator[pa.RecordBatch], start: int, stop: int) -> Iterator[pa.RecordBatch]:
        first, blocks, slices = layout.value

        def sent(side: int, part: pa.RecordBatch, row: np.ndarray, group: np.ndarray, cut_no: np.ndarray, probes: pa.Array | None = None) -> pa.RecordBatch:
            out = part.take(pa.array(row))
            columns = list(out.columns)
            if not side:  # a probing vector's code isn't looked at, nor what it probes elsewhere
                columns[4:] = pa.nulls(len(row), pa.binary()), pa.nulls(len(row), pa.float64()), probes
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(row), side, np.int32)), pa.array(group.astype(np.int32)), pa.array(cut_no.astype(np.int32)), *columns], names=["side", "grp", "cut_no", *part.schema.names])

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, home = mix64(part.column(0).to_numpy().view(np.uint64)).astype(np.int64) & 0x7FFFFFFFFFFFFFFF, part.column(3).to_numpy()
                group = first[home] + ids % blocks[home]
                times = np.where((group >= start) & (group < stop), slices[group], 0)
                row = np.repeat(np.arange(len(ids)), times)
                yield sent(1, part, row, group[row], np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times))
                size = part.column(6).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                row, probed = np.repeat(np.arange(len(ids)), size), part.column(6).flatten().to_numpy()
                times = blocks[probed]
                row, low, probed = np.repeat(row, times), np.repeat(first[probed], times), np.repeat(probed, times)
                group = low + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                here = np.flatnonzero((group >= start) & (group < stop))
                pair = (row * len(slices) + group)[here]
                order = np.argsort(pair, kind="stable")
                pair, off = np.unique(pair[order], return_index=True)
                row, group = pair // len(slices), pair % len(slices)
                lists_here = pa.ListArray.from_arrays(pa.array(np.append(off, len(here)).astype(np.int32)), pa.array(probed[here][order].astype(np.int32)))
                yield sent(0, part, row, group, (ids[row] >> 20) % slices[group], lists_here)

    @tidied
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        x, y = (Side(table.take(pa.array(np.flatnonzero(side == k))), dim) for k in (0, 1))
        if len(x.ids) and len(y.ids):
            nodes, label, n, m = compare(shared.value, least, x, y)
        else:
            nodes, label, n, m = (np.zeros(k, np.int64) for k in (0, 0, len(x.ids), len(y.ids)))
        every = np.concatenate([x.ids, y.ids])
        counted = np.concatenate([n, m])
        some = counted > 0
        nodes, label = local_labels(every[nodes], every[label])
        return pa.table({"a": np.concatenate([every[some], nodes]), "b": np.concatenate([every[some], label]), "n": np.concatenate([counted[some], np.zeros(len(nodes), np.int64)])})

    path = cut_path(spark)
    for low, high in zip(starts[:-1], starts[1:], strict=True):

        @tidied
        def one(batches: Iterator[pa.RecordBatch], start: int = low, stop: int = high) -> Iterator[pa.RecordBatch]:
            yield from deal(batches, start, stop)

        found = cut(indexed.mapInArrow(one, "side int, grp int, cut_no int, " + fields).groupBy("grp", "cut_no").applyInArrow(run, "a long, b long, n long"), path)
        release(spark)
    drop_cut(indexed)
    return found
