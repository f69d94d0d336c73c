"""N-gram Jaccard join (operator 3): an exact set-similarity join with set-relation skipping.

Every document is its set of word shingles, hashed to 64 bits. Equal sets are one class and go on as one. A class indexes
only its prefix in a global order in which frequent shingles come last, so that two sets of Jaccard >= t share a prefix
shingle. Set relations are used twice:

* between lists' blocks: an index list is sorted by set size and, within a size, by the shingle's position. Postings of
  one size are a block. Two blocks whose sizes are too far apart are skipped, and so is a block whose first position
  already leaves too little to overlap; of the others only the postings before the last useful position are read.
* between answers: in a long list every set is first compared with a few leaders, chosen alike in every list. Sets that
  are linked to the same leader share its answer and aren't compared with each other. What is left, sets outside a list's
  largest component against the sets of other components, is derived from the overlaps with the leaders: for a set x
  that resembles leader l, |o & x| <= |o & l| + |x - l| and |o & x| >= |o & l| + |x & l| - |l|, without looking at x.

What the leaders leave open is bounded by counts of shingles by cells of the hash space, a byte for about four shingles,
and what the cells leave is verified by exact overlaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, partitions, release, ship
from tessera.components import connected_components
from tessera.llm.memory import tidied
from tessera.llm.text import Rolling, chunks, mix64, ragged, signed

CHUNK_BYTES = 500_000
#: Ids that are sent to all executors at most, 8 bytes each; more meet the texts in a shuffle.
MOST_SENT = 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = [np.uint64(x) for x in (0x9E6C63D0676A9A99, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165)]


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word [^ \\t-\\r]+ of each text, A-Z in lower case."""
    n = len(data)
    gap = np.ones(n + 1, bool)
    gap[:n] = _SPACE[data]
    first = ~gap[:n]
    first[1:] &= gap[: n - 1]
    inner = off[1:-1]
    inner = inner[inner < n]
    first[inner] = ~gap[inner]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = np.searchsorted(off, start, side="right") - 1
    ends = np.flatnonzero(gap[1:] & ~gap[:n]) + 1  # a gap follows
    end = ends[np.searchsorted(ends, start, side="right")]
    end = np.minimum(end, off[row + 1])
    return mix64(Rolling(_LOWER[data], 101).spans(start, end)), row


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than width make one shingle, none make none."""
    h, row = word_hashes(data, off)
    n = len(off) - 1
    words = np.bincount(row, minlength=n)
    at = np.concatenate([[0], np.cumsum(words)])
    m = max(0, len(h) - width + 1)
    full = np.zeros(m, np.uint64)
    for j in range(width):
        full += h[j : j + m] * _STEPS[j % len(_STEPS)] ** np.uint64(1 + j // len(_STEPS))
    full = mix64(full)
    out = []
    for i in range(n):
        a, b = int(at[i]), int(at[i + 1])
        if b - a >= width:
            s = np.sort(full[a : b - width + 1])
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            s = mix64(np.array([sum(int(x) * int(_STEPS[-1 - j]) for j, x in enumerate(h[a:b])) + b - a & 0xFFFFFFFFFFFFFFFF], np.uint64))
        else:
            s = np.zeros(0, np.uint64)
        out.append(s)
    return out


def prefix_length(n: int, percent: int) -> int:
    """How many shingles of a set of n must be indexed for overlaps of at least percent/100 * n."""
    return n - -(-percent * n // 100) + 1 if n else 0


def cell_counts(s: np.ndarray) -> bytes:
    """How many shingles of a set fall into each of 2**k cells of the hash space, about four a cell, at most 255."""
    bits = max(0, int(len(s) // 4).bit_length() - 1)
    if not bits:
        return bytes([min(255, len(s))])
    return np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def fold_cells(a: np.ndarray, width: int) -> np.ndarray:
    """Rows of cell counts in ``width`` cells; full cells are no bound."""
    a = np.where(a == 255, 1 << 20, a.astype(np.int32))
    return a.reshape(len(a), width, -1).sum(axis=2)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the overlap of two sets from their cell counts; a full cell is no bound."""
    width = min(len(a), len(b))
    return int(np.minimum(fold_cells(a[None, :], width), fold_cells(b[None, :], width)).sum())


class Cells:
    """Cell counts of some sets, by how many cells they have."""

    def __init__(self, cells: list[bytes]):
        self.width = np.array([len(c) for c in cells], np.int64)
        self.at = np.zeros(len(cells), np.int64)
        self.rows: dict[tuple[int, int], np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            mine = np.flatnonzero(self.width == w)
            self.at[mine] = np.arange(len(mine))
            self.rows[w, w] = fold_cells(np.frombuffer(b"".join(cells[i] for i in mine), np.uint8).reshape(-1, w), w)

    def folded(self, width: int, to: int) -> np.ndarray:
        if (width, to) not in self.rows:
            whole = self.rows[width, width]
            self.rows[width, to] = whole.reshape(len(whole), to, -1).sum(axis=2)
        return self.rows[width, to]

    def bounds(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """overlap_bound of pairs of sets."""
        out = np.zeros(len(x), np.int64)
        shape = self.width[x] << 32 | self.width[y]
        for k in np.unique(shape).tolist():
            v, w = k >> 32, k & 0xFFFFFFFF
            width, mine = min(v, w), np.flatnonzero(shape == k)
            a, b = self.folded(v, width), self.folded(w, width)
            step = max(1, 2_000_000 // width)
            for i in range(0, len(mine), step):
                part = mine[i : i + step]
                out[part] = np.minimum(a[self.at[x[part]]], b[self.at[y[part]]]).sum(axis=1)
        return out


def profile(docs: DataFrame, width: int, heavy_share: int) -> DataFrame:
    """Rows that aren't heavy: (id, n, set, cells, t), a set's size, identity and cell counts, and its text's hash; heavy ones: (set = shingle, n = its count in a batch).

    A shingle that more than one in ``heavy_share`` documents hold is reported by some batch, since it is that frequent
    in at least one.
    """

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = ragged(batch.column(1))
            every, sizes, names, cells = [], [], [], []
            for i, j in chunks(off, CHUNK_BYTES):
                found = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], width)
                sizes += map(len, found)
                names.append(set_names(found))
                cells += map(cell_counts, found)
                every += found
            flat = np.sort(np.concatenate(every)) if every else np.zeros(0, np.uint64)
            del every
            names = np.concatenate(names) if names else np.zeros(0, np.uint64)
            edge = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]])) if len(flat) else np.zeros(1, np.int64)
            count = np.diff(edge)
            often = np.flatnonzero(count >= max(4, batch.num_rows / heavy_share))
            k = len(often)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(k, pa.int64())]),
                    pa.array(np.concatenate([np.array(sizes, np.int64), count[often]])),
                    pa.array(signed(np.concatenate([names, flat[edge[often]]]))),
                    pa.array([False] * len(sizes) + [True] * k),
                    pa.array(cells + [None] * k, pa.binary()),
                    pa.concat_arrays([batch.column(2), pa.nulls(k, pa.int64())]),
                ],
                names=["id", "n", "set", "heavy", "cells", "t"],
            )

    return docs.select("id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, "id long, n long, set long, heavy boolean, cells binary, t long")


def set_names(sets: list[np.ndarray]) -> np.ndarray:
    """64 bits for each set that tell sets apart."""
    size = np.array([len(s) for s in sets], np.int64)
    out, some = np.zeros(len(sets), np.uint64), np.flatnonzero(size)
    if len(some):
        flat = np.concatenate([sets[i] for i in some])
        start = np.cumsum(size[some]) - size[some]
        out[some] = mix64(np.add.reduceat(flat, start) + mix64(np.add.reduceat(mix64(flat ^ _STEPS[0]), start) + size[some].astype(np.uint64)))
    return out


def in_order(s: np.ndarray, heavy: np.ndarray, count: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` shingles of a sorted set in the global order: rare ones by hash, then heavy ones by count."""
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
        is_heavy = heavy[at] == s
        if is_heavy.any():
            rare = s[~is_heavy]
            if len(rare) >= most:
                return rare[:most]
            often, c = s[is_heavy], count[at[is_heavy]]
            return np.concatenate([rare, often[np.lexsort((often, c))]])[:most]
    return s[:most]


def list_pairs(token: np.ndarray, rep: np.ndarray, size: np.ndarray, pos: np.ndarray, percent: int, longest: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """((x, y, token) of the pairs that short lists bring together, which postings are in long lists).

    Postings are sorted by (token, size, pos). Those of one token and size are a block. For each distance k between
    blocks of a list all block pairs k apart are tried at once; a block pair is skipped where sizes are too far apart or
    where the first position of either leaves too little, and read up to the last positions that leave enough.
    """
    edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
    run = np.diff(edge)
    in_long = np.repeat(run > longest, run)
    keep = np.repeat((run > 1) & (run <= longest), run)
    token, rep, size, pos = token[keep], rep[keep], size[keep], pos[keep]
    xs, ys, ts = [], [], []
    if len(token):
        start = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (size[1:] != size[:-1])]))
        block = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(token))))
        place = block << 32 | pos
        held, least, width = token[start], pos[start], size[start]

        def readable(b: np.ndarray, last: np.ndarray) -> np.ndarray:
            return np.searchsorted(place, b << 32 | np.maximum(last, -1) + 1) - start[b]

        b, k = np.arange(len(start)), 0
        while len(b):
            c = b + k
            here = c < len(start)
            b, c = b[here], c[here]
            # sizes grow along the list: once a block is too large, so is all that follows
            near = (held[b] == held[c]) & (100 * width[b] >= percent * width[c])
            b, c = b[near], c[near]
            need = -(-percent * (width[b] + width[c]) // (100 + percent))
            open_ = (least[b] <= width[b] - need) & (least[c] <= width[c] - need)
            u, v, need = b[open_], c[open_], need[open_]
            m, n = readable(u, width[u] - need), readable(v, width[v] - need)
            pairs = m * n
            at = np.arange(int(pairs.sum())) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            many = np.repeat(n, pairs)
            x, y = np.repeat(start[u], pairs) + at // np.maximum(many, 1), np.repeat(start[v], pairs) + at % np.maximum(many, 1)
            ok = (rep[x] != rep[y]) & ((x < y) if k == 0 else True)
            xs.append(rep[x[ok]])
            ys.append(rep[y[ok]])
            ts.append(token[x[ok]])
            k += 1
    cat = lambda parts, dtype: np.concatenate(parts) if parts else np.zeros(0, dtype)
    return (cat(xs, np.int64), cat(ys, np.int64), cat(ts, np.uint64)), in_long


def window_most(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The largest of v[a:b] for each window, -1 for empty ones."""
    out = np.full(len(a), -1, np.int64)
    width, most = np.maximum(b - a, 0), 1
    while (width >= most).any():
        mine = np.flatnonzero((width >= most) & (width < 2 * most))
        out[mine] = np.maximum(v[a[mine]], v[b[mine] - most])
        v = np.maximum(v[:-most], v[most:])
        most *= 2
    return out


def partnered(token: np.ndarray, size: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Which postings have another in their list with which sizes and positions leave enough overlap.

    Postings are whole lists sorted by (token, size, pos). One of size n at place k reaches sizes up to the largest m
    with percent * (n + m) <= (100 + percent) * (n - k), and two may link if each reaches the other's size.
    """
    if not len(token):
        return np.zeros(0, bool)
    reach = (size - pos) * (100 + percent) // percent - size
    group = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) << 32
    key, at = group + size, np.arange(len(token))
    lo, hi = np.searchsorted(key, group - (-percent * size // 100)), np.searchsorted(key, group + np.maximum(reach, -1) + 1)
    return np.maximum(window_most(reach, lo, np.minimum(at, hi)), window_most(reach, np.maximum(lo, at + 1), hi)) >= size


def jaccard_join(docs: DataFrame, *, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text", longest_list: int = 32, leaders: int = 4, heavy_share: int = 1000, most_heavy: int = 1_000_000) -> DataFrame:
    """One row per document: (id, n_shingles, component_id, component, text_hash), linking sets of Jaccard >= percent / 100.

    Words are [^ \\t-\\r]+ of the whole text with A-Z in lower case. A document of fewer words than ``width`` is one
    shingle; one without words, or of null text, has no shingles and links with nothing. component_id is the smallest id
    that links reach, itself included; component is another name of what links reach, which documents of one id and
    unlinked texts don't share (null without shingles), and text_hash is xxhash64 of the text. Ids are long. Rows keep
    their number: a repeated row repeats its result, rows of one id with several texts are told apart by their sets, a
    null id has a null component. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = cut(profile(plain, width, heavy_share))
    sets = found.where("not heavy and n > 0 and id is not null").select("id", "n", "set", "t")
    n_docs = found.where("not heavy").count()
    # any subset of the frequent shingles gives a valid order, so the table sent out has a fixed bound: 16 bytes each
    heavy = found.where("heavy").groupBy("set").agg(F.sum("n").alias("n")).where(F.col("n") >= max(8, n_docs // heavy_share)).orderBy(F.desc("n"), "set").limit(most_heavy).toPandas()
    token = heavy["set"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    shared = spark.sparkContext.broadcast((token[order], heavy["n"].to_numpy(np.int64)[order]))
    classes = cut(sets.groupBy("set", "n").agg(F.min("id").alias("id")))
    chosen = classes.select("id", F.col("set").alias("rep"))
    cells = cut(found.where("not heavy").select("id", "n", "cells", F.col("set").alias("rep")).join(chosen, ["id", "rep"], "left_semi").dropDuplicates(["rep"]).drop("id"))
    edges = _links(plain, chosen, cells, shared, percent, width, longest_list, leaders, partitions(spark))
    joined = cut(connected_components(edges).withColumnRenamed("id", "set").join(classes.select("set", "id"), "set"))
    smallest = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    named = joined.join(smallest, "component").select("set", "component", "component_id")
    named = classes.join(named, "set", "left").select("set", "n", F.coalesce("component", "set").alias("component"), F.coalesce("component_id", "id").alias("component_id"))
    linked = sets.join(named, ["set", "n"]).select("id", F.col("n").alias("n_shingles"), "component_id", "component", F.col("t").alias("text_hash"))
    alone = found.where("not heavy and (n = 0 or id is null)").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(None).cast("long").alias("component"), F.col("t").alias("text_hash"))
    return linked.unionByName(alone)


def _links(plain: DataFrame, chosen: DataFrame, cells: DataFrame, shared, percent: int, width: int, longest: int, leaders: int, parts: int) -> DataFrame:
    """(a, b) of linked classes; chosen (id, rep) names the document that stands for a class."""
    spark = plain.sparkSession
    n_classes = chosen.count()
    buckets = max(parts, n_classes // 4000)

    @tidied
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, count = shared.value
        for batch in batches:
            data, off = ragged(batch.column(1))
            ids = batch.column(0)
            for i, j in chunks(off, CHUNK_BYTES):
                found = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], width)
                prefix = [in_order(s, heavy, count, prefix_length(len(s), percent)).tobytes() if len(s) else None for s in found]
                part = pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(signed(set_names(found))), pa.array([len(s) for s in found], pa.int64()), pa.array(prefix, pa.binary())], names=["id", "rep", "n", "prefix"])
                yield part.filter(pc.and_(pc.is_valid(part.column(0)), pc.is_valid(part.column(3))))

    prefixes = plain.mapInArrow(index, "id long, rep long, n long, prefix binary")
    prefixes = prefixes.join(chosen, ["id", "rep"], "left_semi")

    @tidied
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Postings of a batch by bucket of their token; those of heavy shingles, whose lists are long, by token and set."""
        heavy, often = shared.value
        heavy = heavy[often > longest]
        for batch in batches:
            reps, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, off = ragged(batch.column(2))
            if not len(reps):
                continue
            tokens = np.frombuffer(data.tobytes(), np.uint64)
            count = np.diff(off) // 8
            rep, size = np.repeat(reps, count), np.repeat(n, count)
            pos = (np.arange(len(tokens)) - np.repeat(off[:-1] // 8, count)).astype(np.int32)
            bucket = (mix64(tokens) % np.uint64(buckets)).astype(np.int32)
            if len(heavy):
                hot = heavy[np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)] == tokens
                bucket[hot] = buckets + (mix64(tokens[hot] ^ mix64(rep[hot].view(np.uint64))) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            edge = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1], [True]]))
            pieces = [order[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[p[0]]) for p in pieces], pa.int32()), *(pa.array([x[p].tobytes() for p in pieces], pa.binary()) for x in (tokens, rep, size.astype(np.int32), pos))], names=["bucket", "token", "rep", "size", "pos"])

    fields = "x long, y long, token long, size long"

    @tidied
    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        token, rep, size, pos = (np.frombuffer(b"".join(rows[c]), t) for c, t in (("token", np.uint64), ("rep", np.int64), ("size", np.int32), ("pos", np.int32)))
        order = np.lexsort((rep, pos, size, token))
        token, rep, size, pos = token[order], rep[order], size[order].astype(np.int64), pos[order].astype(np.int64)
        (x, y, t), in_long = list_pairs(token, rep, size, pos, percent, longest if key[0] < buckets else 0)
        pairs = pd.DataFrame({"x": np.minimum(x, y), "y": np.maximum(x, y), "token": signed(t), "size": np.zeros(len(x), np.int64)})
        pairs = pairs.drop_duplicates(["x", "y"])
        # postings of long lists go on as they are: their size is positive, and y is their position
        if key[0] < buckets:  # whole lists
            in_long[in_long] = partnered(token[in_long], size[in_long], pos[in_long], percent)
        rest = pd.DataFrame({"x": rep[in_long], "y": pos[in_long], "token": signed(token[in_long]), "size": size[in_long]})
        return pd.concat([pairs, rest])

    met = cut(prefixes.select("rep", "n", "prefix").mapInArrow(deal, "bucket int, token binary, rep binary, size binary, pos binary").groupBy("bucket").applyInPandas(meet, fields))
    release(spark)
    short = met.where("size = 0").select("x", "y", "token")
    long = met.where("size > 0").select(F.col("x").alias("rep"), F.col("size").alias("n"), F.col("y").alias("pos"), "token")
    # leaders are the sets with the fewest rarer shingles: copies with the fewest edits
    firsts = [F.min(F.struct("pos", F.xxhash64(F.lit(i), "rep").alias("h"), "rep", "n")).alias(f"l{i}") for i in range(leaders)]
    heads = long.groupBy("token").agg(*firsts).select("token", F.explode(F.array(*[f"l{i}" for i in range(leaders)])).alias("l")).select("token", F.col("l.rep").alias("o"), F.col("l.n").alias("m"), F.col("l.pos").alias("opos")).distinct()
    need = F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))
    may_link = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("opos")) >= need) & (F.col("rep") != F.col("o"))
    one_list = long.groupBy("rep").agg(F.min_by(F.struct("n", "pos", "token"), F.struct("pos", "token")).alias("s")).select("rep", "s.n", "s.pos", "s.token")
    star = one_list.join(heads, "token").where(may_link).select(F.least("rep", "o").alias("x"), F.greatest("rep", "o").alias("y"), "token")
    first = cut(_verify(plain, chosen, _bounded(short.unionByName(star), cells, percent), percent, width))
    release(spark)
    links = first.where("linked").select("a", "b")
    if not long.limit(1).count():
        return links
    # answers of the leaders: a list of one component is done; else its sets outside the largest one meet the others
    answer = connected_components(links)
    known = cut(long.join(answer.withColumnRenamed("id", "rep"), "rep", "left").select("token", "rep", "n", "pos", F.coalesce("component", "rep").alias("c")))
    split = known.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("token")
    open_lists = known.join(split, "token", "left_semi")
    leading = heads.select(F.col("o").alias("leader")).distinct()
    both_ways = first.select(F.col("a").alias("rep"), F.col("b").alias("leader"), "both", F.col("nb").alias("size")).unionByName(first.select(F.col("b").alias("rep"), F.col("a").alias("leader"), "both", F.col("na").alias("size")))
    best = F.slice(F.sort_array(F.collect_list(F.struct("both", "leader", "size")), asc=False), 1, leaders)
    like = both_ways.join(leading, "leader", "left_semi").groupBy("rep").agg(best.alias("like"))
    across = _across(open_lists, cells, like, percent)
    sure = across.where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))
    tested = _verify(plain, chosen, across.where("not linked").select("x", "y", "token"), percent, width).where("linked").select("a", "b")
    return links.unionByName(sure).unionByName(cut(tested))


def _across(open_lists: DataFrame, cells: DataFrame, like: DataFrame, percent: int, outside_rows: int = 1024, member_rows: int = 16_384) -> DataFrame:
    """(x, y, token, linked): pairs of different components within a list, surely linked or to be verified.

    open_lists (token, rep, n, pos, c) are lists of more than one component. Sets outside a list's largest component meet
    all its sets, in slices of both, and no pair is a row before sizes, positions, leaders and cells have left it open.
    """
    spark = open_lists.sparkSession
    counts = open_lists.groupBy("token", "c").count().groupBy("token").agg(F.max(F.struct("count", F.negate("c").alias("c"))).alias("m"), F.sum("count").alias("all"))
    main = counts.select("token", F.negate(F.col("m.c")).alias("main"), F.ceil((F.col("all") - F.col("m.count")) / outside_rows).cast("int").alias("outer"), F.ceil(F.col("all") / member_rows).cast("int").alias("inner"))
    placed = open_lists.join(main, "token")
    member = F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("inner")).cast("int")
    outer = F.pmod(F.xxhash64(F.lit(2), "rep"), F.col("outer")).cast("int")
    plain = ("token", "rep", "n", "pos", "c")
    inside = placed.select(*plain, F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), F.col("outer") - 1)).alias("u"), member.alias("v"))
    outside = placed.where("c <> main").select(*plain, F.lit(1).alias("side"), outer.alias("u"), F.explode(F.sequence(F.lit(0), F.col("inner") - 1)).alias("v"))
    rows = cut(inside.unionByName(outside))
    buckets = max(partitions(spark), rows.count() // 20_000)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("token", "u", "v"), F.lit(buckets)))
    known = rows.select(F.col("bucket").alias("slot"), F.col("rep").alias("rep")).distinct().join(cells.select("rep", "cells"), "rep").join(like, "rep", "left")

    @tidied
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("rep", ignore_index=True)
        names, held = right["rep"].to_numpy(np.int64), Cells(list(right["cells"]))
        width = max([1, *(len(x) for x in right["like"] if x is not None)])
        leader, both, whole = (np.full((len(names), width), k, np.int64) for k in (-1, 0, 0))
        for i, found in enumerate(right["like"]):
            for j, f in enumerate(found if found is not None else ()):
                leader[i, j], both[i, j], whole[i, j] = f["leader"], f["both"], f["size"]
        group = pd.factorize(pd.MultiIndex.from_frame(left[["token", "u", "v"]]))[0].astype(np.int64)
        left = left.iloc[np.lexsort((left["n"], group))]
        group = np.sort(group)
        rep, n, pos, c, token = (left[k].to_numpy(np.int64) for k in ("rep", "n", "pos", "c", "token"))
        row = np.searchsorted(names, rep)
        y = np.flatnonzero(left["side"].to_numpy() == 0)
        x = np.flatnonzero(left["side"].to_numpy() == 1)
        place = group[y] << 32 | n[y]
        lo = np.searchsorted(place, group[x] << 32 | -(-percent * n[x] // 100))
        hi = np.searchsorted(place, group[x] << 32 | 100 * n[x] // percent + 1)
        out = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)]
        ends = np.cumsum(hi - lo)
        at = 0
        while at < len(x):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000)))
            many = (hi - lo)[at:stop]
            i = np.repeat(x[at:stop], many)
            j = y[np.arange(len(i)) - np.repeat(np.cumsum(many) - many - lo[at:stop], many)]
            at = stop
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            ok = (c[i] != c[j]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need)
            i, j, need = i[ok], j[ok], need[ok]
            most, least = np.minimum(n[i], n[j]), np.zeros(len(i), np.int64)
            for s in range(width):
                for t in range(width):
                    a, b = row[i], row[j]
                    same = (leader[a, s] == leader[b, t]) & (leader[a, s] != -1)
                    p, q = both[a, s], both[b, t]
                    most = np.where(same, np.minimum(most, np.minimum(p + n[j] - q, q + n[i] - p)), most)
                    least = np.where(same, np.maximum(least, p + q - whole[a, s]), least)
            ok = most >= need
            i, j, need, sure = i[ok], j[ok], need[ok], (least >= need)[ok]
            ok = sure.copy()
            ok[~sure] = held.bounds(row[i[~sure]], row[j[~sure]]) >= need[~sure]
            i, j = i[ok], j[ok]
            out.append((np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j]), token[i], sure[ok]))
        found = pd.DataFrame({k: np.concatenate([o[m] for o in out]) for m, k in enumerate(("x", "y", "token", "linked"))})
        return found.drop_duplicates(["x", "y"])

    fields = "x long, y long, token long, linked boolean"
    return cut(rows.groupBy("bucket").cogroup(known.groupBy("slot")).applyInPandas(run, fields))


def _grouped(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((x, y, token, bucket) of distinct pairs, (slot, rep) of the sets that each bucket of them needs).

    A pair belongs to the first list that brought it together. Buckets hold some thousand pairs, of whole short lists and
    of slices of lists of many pairs.
    """
    spark = pairs.sparkSession
    once = cut(pairs.groupBy("x", "y").agg(F.min("token").alias("token")))
    buckets = max(partitions(spark), once.count() // 4096)
    sizes = once.groupBy("token").count().where("count > 512").select("token", F.ceil(F.col("count") / 512).cast("int").alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("x", "y"), F.col("parts")), F.lit(0))
    once = cut(once.join(sizes, "token", "left").select("x", "y", "token", F.pmod(F.xxhash64("token", part), F.lit(buckets)).cast("int").alias("bucket")))
    return once, once.select(F.col("bucket").alias("slot"), F.explode(F.array("x", "y")).alias("rep")).distinct()


def _bounded(pairs: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """The pairs whose cell counts leave enough overlap: (x, y, token)."""
    once, wanted = _grouped(pairs)
    members = wanted.join(cells, "rep").select("slot", "rep", "n", "cells")

    @tidied
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("rep")
        rep, n, held = right["rep"].to_numpy(np.int64), right["n"].to_numpy(np.int64), Cells(list(right["cells"]))
        x, y = (np.searchsorted(rep, left[c].to_numpy(np.int64)) for c in ("x", "y"))
        return left.loc[(100 + percent) * held.bounds(x, y) >= percent * (n[x] + n[y]), ["x", "y", "token"]]

    return cut(once.groupBy("bucket").cogroup(members.groupBy("slot")).applyInPandas(run, "x long, y long, token long"))


def _verify(plain: DataFrame, chosen: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """(a, b, both, na, nb, linked) of the pairs (x, y, token): exact overlap, sizes, and whether it links them."""
    once, wanted = _grouped(pairs)
    needed = cut(wanted.select("rep").distinct().join(chosen, "rep"))
    ids = needed.select("id").distinct()
    if needed.count() <= MOST_SENT:
        ids = F.broadcast(ids)  # so the texts stay where they are

    @tidied
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = ragged(batch.column(1))
            for i, j in chunks(off, CHUNK_BYTES):
                out = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], width)
                names = signed(set_names(out))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(names), pa.array([s.tobytes() for s in out], pa.binary())], names=["id", "rep", "s"])

    built = plain.join(ids, "id", "left_semi").mapInArrow(sets, "id long, rep long, s binary").join(chosen, ["id", "rep"], "left_semi")
    members = wanted.join(built.drop("id"), "rep")

    @tidied
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        held = {i: np.frombuffer(s, np.uint64) for i, s in zip(right["rep"], right["s"], strict=True)}
        both, na, nb = [], [], []
        for x, y in zip(left["x"], left["y"], strict=True):
            s, t = held[x], held[y]
            na.append(len(s))
            nb.append(len(t))
            if len(s) > len(t):
                s, t = t, s
            at = np.searchsorted(t, s)
            at[at == len(t)] = 0
            both.append(int(np.count_nonzero(t[at] == s)))
        both, na, nb = (np.array(v, np.int64) for v in (both, na, nb))
        return pd.DataFrame({"a": left["x"].to_numpy(np.int64), "b": left["y"].to_numpy(np.int64), "both": both, "na": na, "nb": nb, "linked": 100 * both >= percent * (na + nb - both)})

    return once.groupBy("bucket").cogroup(members.groupBy("slot")).applyInPandas(run, "a long, b long, both long, na long, nb long, linked boolean")
