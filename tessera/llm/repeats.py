"""Suffix-array dedup (operator 2): which windows of ``length`` bytes also start elsewhere, and which have an earlier copy.

A window has an earlier copy when its suffix's longest previous factor is at least ``length`` long. That factor is found
from the suffix's neighbours of smaller position before and after it in suffix order. The suffixes are sorted in
partitions that no match can cross: every window is assigned to its anchor, the smallest hash among its k-grams
(ties: the last), so equal windows have equal anchors at equal places. Then

1. anchors of all texts are grouped. Where an anchor comes once, none of its windows repeats. Where the whole context
   (all bytes of an anchor's windows) repeats, all of its windows do, and all but the first occurrence are later copies.
2. what is left are the ends of repeated passages: contexts that share an anchor and differ. Within an anchor the
   suffixes at distance d before it are ordered by the d bytes before it and the order of what follows; runs with a
   common prefix of ``length`` bytes are equal windows, and in a run the previous and next smaller positions tell
   earlier copies. One sort of the bytes before and one of the bytes after serve all d.
3. anchors that more than one in ``heavy_share`` documents hold in unequal contexts would be one large group; their
   windows are grouped by 128-bit hashes of their own instead.

Equal occurrences within a batch are settled there, so a passage in every document sends one row a batch, not one a
document. Contexts and windows are compared by 128 bits of hash in steps 1 and 3 and byte by byte in step 2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, drop_cut, partitions, release, ship
from tessera.llm.memory import tidied
from tessera.llm.text import Rolling, chunks, mix64, ragged, signed, sized

#: Bytes of text that are hashed at once; some 150 bytes of working memory each.
CHUNK_BYTES = 500_000
ANCHOR = np.dtype([("a", "u8"), ("c", "u8"), ("id", "i8"), ("pos", "u4"), ("dlo", "u1"), ("dhi", "u1"), ("multi", "u1"), ("hot", "u1")])
#: A mark says that windows lo..hi of a document repeat, and whether as later copies.
MARK = np.dtype([("id", "i8"), ("lo", "u4"), ("hi", "u4"), ("any", "u1"), ("later", "u1")])
WINDOW = np.dtype([("h", "u8"), ("g", "u8"), ("id", "i8"), ("pos", "u4"), ("multi", "u1")])


def suffix_array(data: bytes) -> np.ndarray:
    """Suffix array by prefix doubling."""
    n = len(data)
    rank = np.frombuffer(data, np.uint8).astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while n:
        second = np.full(n, -1, np.int64)
        second[: n - k] = rank[k:] if k < n else []
        order = np.lexsort((second, rank))
        new = np.concatenate([[True], (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if rank[order[-1]] == n - 1:
            break
        k *= 2
    return order


def smaller_neighbours(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous, next) index with a smaller position for each place of a suffix order; -1 and n where there is none."""

    def before(x: np.ndarray) -> np.ndarray:
        # what lies between a place and its candidate is larger, so the candidate's own candidate may take its place
        held, at = np.append(x, np.iinfo(np.int64).min), np.arange(-1, len(x) - 1)
        todo = np.flatnonzero(held[at] > x)
        while len(todo):
            at[todo] = at[at[todo]]
            todo = todo[held[at[todo]] > x[todo]]
        return at

    n, position = len(position), np.asarray(position, np.int64)
    return before(position), n - 1 - before(position[::-1])[::-1]


def longest_previous_factor(data: bytes) -> np.ndarray:
    """For each position of one text the length of its longest match that starts earlier. For single texts and tests."""
    sa = suffix_array(data)
    n = len(sa)
    prev, nxt = smaller_neighbours(sa)
    out = np.zeros(n, np.int64)
    for i in range(n):
        for j in (prev[i], nxt[i]):
            if 0 <= j < n:
                a, b, k = int(sa[i]), int(sa[j]), 0
                while a + k < n and b + k < n and data[a + k] == data[b + k]:
                    k += 1
                out[sa[i]] = max(out[sa[i]], k)
    return out


def earlier_in_run(run: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shared, later) for suffixes in order: run numbers those with a common prefix, position is their place in the text.

    A suffix's longest previous factor reaches as far as the run's common prefix exactly if its previous or its next
    smaller position in suffix order lies in its run: all others have a shorter prefix in common with it.
    """
    n = len(run)
    edge = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    size = np.diff(np.append(edge, n))
    step = np.int64(position.max(initial=0)) + 1
    number = np.repeat(np.arange(len(edge)), size)
    prev, _ = smaller_neighbours(number * step + position)  # runs are walls: the one before is smaller, the one after too
    _, nxt = smaller_neighbours((len(edge) - number) * step + position)
    inside = (prev >= 0) & (number[prev] == number)
    ahead = np.minimum(nxt, n - 1)
    inside |= (nxt < n) & (number[ahead] == number)
    return np.repeat(size > 1, size), inside


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, from running minima of blocks of w from both ends."""
    n = len(x)
    if n < w:
        return x[:0]
    pad = -n % w
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, off: np.ndarray, ids: np.ndarray, length: int, k: int) -> np.ndarray:
    """Anchors of all windows of some texts, with the range of distances d from window start to anchor."""
    w = length - k + 1
    n = len(data)
    if n < length:
        return np.zeros(0, ANCHOR)
    one, two = Rolling(data, 211), Rolling(data, 223)
    gram = mix64(one.fixed(k))
    low = np.uint64((1 << 24) - 1)
    place = np.arange(len(gram), dtype=np.uint64)
    best = sliding_min((gram & ~low) | (low - place), w)  # one for each window start; later places win ties
    at = (low - (best & low)).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    m = len(at)
    inside = row[:m] == row[length - 1 : length - 1 + m]
    start = np.flatnonzero(inside)
    if not len(start):
        return np.zeros(0, ANCHOR)
    a, r = at[start], row[start]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.append(new[1:], len(start)) - 1
    p, lo, hi = a[new], start[new], start[last]
    out = np.zeros(len(new), ANCHOR)
    out["a"] = gram[p]
    out["dlo"], out["dhi"] = p - hi, p - lo
    shape = out["dlo"].astype(np.uint64) << np.uint64(8) | out["dhi"]
    out["c"] = mix64(two.spans(lo, hi + length) ^ mix64(one.spans(lo, hi + length) + shape))
    out["id"] = ids[r[new]]
    out["pos"] = p - off[r[new]]
    return out


def sliced_anchors(data: np.ndarray, off: np.ndarray, ids: np.ndarray, length: int, k: int, size: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    """anchors() of some texts; a single text longer than ``size`` in slices, so that places fit their 24 bits.

    A slice starts with the windows of the last anchor before, which the end of that slice may have cut short.
    """
    n = len(data)
    if n <= size or len(off) > 2:
        yield anchors(data, off, ids, length, k)
        return
    at = 0
    while True:
        end = min(n, at + size)
        rows = anchors(data[at:end], np.array([0, end - at]), ids, length, k)
        rows["pos"] += np.uint32(at)
        if end == n:
            yield rows
            return
        yield rows[:-1]
        at = int(rows["pos"][-1]) - int(rows["dhi"][-1])


def joined(found: np.ndarray) -> np.ndarray:
    """Marks of one kind with those whose windows adjoin or overlap as one."""
    if len(found) < 2:
        return found
    found = found[np.lexsort((found["lo"], found["id"]))]
    group = np.concatenate([[True], found["id"][1:] != found["id"][:-1]])
    hi = found["hi"].astype(np.int64)
    far = np.maximum.accumulate(hi + (np.cumsum(group) << 33)) - (np.cumsum(group) << 33)  # within an id
    new = np.flatnonzero(group | np.concatenate([[True], found["lo"][1:] > far[:-1] + 1]))
    out = found[new]
    out["hi"] = np.maximum.reduceat(hi, new)
    return out


def settle(rows: np.ndarray, keys: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(one row of each key with the smallest (id, pos), multi set where there are more; the other rows)."""
    order = np.lexsort((rows["pos"], rows["id"], *(rows[k] for k in reversed(keys))))
    rows = rows[order]
    same = np.ones(max(0, len(rows) - 1), bool)
    for k in keys:
        same &= rows[k][1:] == rows[k][:-1]
    first = np.concatenate([[True], ~same])[: len(rows)]
    kept = rows[first].copy()
    group = np.cumsum(first) - 1
    many = np.bincount(group, minlength=len(kept)) > 1
    again = np.zeros(len(kept), bool)
    np.logical_or.at(again, group, rows["multi"] > 0)
    kept["multi"] = many | again
    return kept, rows[~first]


def marks(rows: np.ndarray, later: int) -> np.ndarray:
    out = np.zeros(len(rows), MARK)
    out["id"] = rows["id"]
    out["lo"], out["hi"] = rows["pos"] - rows["dhi"], rows["pos"] - rows["dlo"]
    out["any"], out["later"] = 1, later
    return out


def deal(kind: int, rows: np.ndarray, bucket: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Rows packed by bucket: (kind, bucket, bytes)."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    edge = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, np.int64)
    return [(kind, int(b[s]), rows[order[s:e]].tobytes()) for s, e in zip(edge[:-1], edge[1:], strict=True)]


def batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["kind", "bucket", "rows"])


def unpack(col: pa.ChunkedArray, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype)


#: Least counts, in a batch and in all, of an anchor that may be heavy.
HEAVY_LEAST = (8, 64)
MARKS, ANCHORS, HEAVY, EDGES, TEXTS, WINDOWS = range(6)
PACKED = "kind int, bucket int, rows binary"


def doc_bucket(ids: np.ndarray, n: int) -> np.ndarray:
    return (mix64(ids.view(np.uint64) if ids.dtype == np.int64 else ids.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int32)


def match_contexts(rows: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Marks for contexts of some anchors: left are the bytes before the anchor, backwards, right those from it on.

    For each distance d, suffixes are ordered by the class of their d bytes before and length - d bytes after the anchor.
    """

    def classes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = np.zeros((len(x), -(-x.shape[1] // 8) * 8), np.uint8)
        words[:, : x.shape[1]] = x
        order = np.lexsort((*words.view(">u8").T[::-1], rows["a"]))
        a, b = x[order[1:]], x[order[:-1]]
        differ = a != b
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
        lcp[rows["a"][order[1:]] != rows["a"][order[:-1]]] = -1
        return order, np.concatenate([[-1], lcp])

    (lorder, llcp), (rorder, rlcp) = classes(left), classes(right)
    rank = np.empty(len(rows), np.int64)
    rank[np.lexsort((rows["pos"], rows["id"]))] = np.arange(len(rows))
    same = np.flatnonzero(np.concatenate([[False], (np.sort(rows[["id", "pos"]], order=("id", "pos"))[1:] == np.sort(rows[["id", "pos"]], order=("id", "pos"))[:-1])]))
    if len(same):  # a repeated row's places are one place
        rank = np.unique(np.stack([rows["id"], rows["pos"].astype(np.int64)]), axis=1, return_inverse=True)[1].ravel()
    out = []
    lclass, rclass = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for d in range(int(rows["dlo"].min()), int(rows["dhi"].max()) + 1):
        here = np.flatnonzero((rows["dlo"] <= d) & (d <= rows["dhi"]))
        if len(here) < 2:
            continue
        lclass[lorder] = np.cumsum(llcp < d)
        rclass[rorder] = np.cumsum(rlcp < length - d)
        key = lclass[here] * (len(rows) + 1) + rclass[here]
        order = np.lexsort((rank[here], key))
        shared, later = earlier_in_run(key[order], rank[here][order])
        got = here[order[shared]]
        m = np.zeros(len(got), MARK)
        m["id"], m["any"], m["later"] = rows["id"][got], 1, later[shared]
        m["lo"] = m["hi"] = rows["pos"][got] - d
        out.append(m)
    return np.concatenate(out) if out else np.zeros(0, MARK)


def repeated_windows(docs: DataFrame, *, length: int = 200, k: int = 64, id_col: str = "id", text_col: str = "text", heavy_share: int = 1000, bucket_bytes: int = 2_000_000) -> tuple[DataFrame, int]:
    """(packed marks by document bucket, number of buckets) of the windows that repeat."""
    if not 8 <= k <= length <= k + 255:
        raise ValueError("needs 8 <= k <= length <= k + 255")
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = plain.agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).collect()[0]
    n_docs, least = max(1, size.n), HEAVY_LEAST
    groups = max(partitions(spark), -(-(size.bytes or 0) // bucket_bytes))
    buckets = max(partitions(spark), (size.bytes or 0) // (4 * bucket_bytes))

    @tidied
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized(batches):
            data, off = ragged(part.column(1))
            ids = part.column(0).to_numpy()
            every, again = [np.zeros(0, ANCHOR)], []
            for i, j in chunks(off, CHUNK_BYTES):
                for rows in sliced_anchors(data[off[i] : off[j]], off[i : j + 1] - off[i], ids[i:j], length, k):
                    kept, copies = settle(rows, ("a", "c"))
                    every.append(kept)
                    again.append(joined(marks(copies, 1)))
            kept, copies = settle(np.concatenate(every), ("a", "c"))
            again = np.concatenate([*again, marks(copies, 1)])
            held, count = np.unique(kept["a"], return_counts=True)
            often = count >= max(least[0], part.num_rows / heavy_share)
            heavy = np.stack([held[often], count[often].astype(np.uint64)], axis=1)
            out = deal(MARKS, again, doc_bucket(again["id"], groups))
            out += deal(ANCHORS, kept, (mix64(kept["a"]) % np.uint64(buckets)).astype(np.int32))
            yield batch(out + ([(HEAVY, 0, heavy.tobytes())] if len(heavy) else []))

    first = cut(plain.mapInArrow(scan, PACKED))

    @tidied
    def heavy_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(signed(rows[:, 0].copy())), pa.array(rows[:, 1].astype(np.int64))], names=["a", "n"])

    # at most heavy_share * (anchors of a mean document) of them, 8 bytes each
    heavy = first.where(f"kind = {HEAVY}").mapInArrow(heavy_rows, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= max(least[1], n_docs // heavy_share)).select("a").toPandas()
    shared = spark.sparkContext.broadcast(np.sort(heavy["a"].to_numpy(np.int64).view(np.uint64)))

    @tidied
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors in their buckets; those of heavy anchors go by their context."""
        hot = shared.value
        for part in batches:
            if not len(hot):
                yield part
                continue
            out = []
            for b, packed in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                rows = np.frombuffer(packed, ANCHOR).copy()
                rows["hot"] = hot[np.minimum(np.searchsorted(hot, rows["a"]), len(hot) - 1)] == rows["a"]
                is_hot = rows["hot"] > 0
                out += [(ANCHORS, b, rows[~is_hot].tobytes())] + deal(ANCHORS, rows[is_hot], (mix64(rows["a"][is_hot] ^ rows["c"][is_hot]) % np.uint64(buckets)).astype(np.int32))
            yield batch(out)

    @tidied
    def group(table: pa.Table) -> pa.Table:
        kept, copies = settle(unpack(table.column("rows"), ANCHOR), ("a", "c"))
        held, at, count = np.unique(kept["a"], return_inverse=True, return_counts=True)
        repeated = marks(kept[kept["multi"] > 0], 0)
        edges = kept[(count[at] > 1) | (kept["hot"] > 0)]
        out = deal(MARKS, marks(copies, 1), doc_bucket(copies["id"], groups)) + deal(MARKS, repeated, doc_bucket(repeated["id"], groups)) + deal(EDGES, edges, doc_bucket(edges["id"], groups))
        return pa.Table.from_batches([batch(out)])

    grouped = cut(first.where(f"kind = {ANCHORS}").mapInArrow(spread, PACKED).groupBy("bucket").applyInArrow(group, PACKED))
    release(spark)

    @tidied
    def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids = part.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(doc_bucket(ids, groups)), part.column(0), part.column(1)], names=["bucket", "id", "text"])

    texts = plain.mapInArrow(pack_texts, "bucket int, id long, text string")
    hot_buckets = buckets

    @tidied
    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        """Bytes around each edge; windows of heavy anchors by hash instead."""
        edges = np.unique(unpack(right.column("rows"), ANCHOR))
        ids = left.column("id").to_numpy()
        data, off = ragged(left.column("text"))
        where = dict(zip(ids.tolist(), range(len(ids)), strict=True))
        out: list[tuple[int, int, bytes]] = []
        at = np.array([off[where[i]] for i in edges["id"].tolist()], np.int64)
        lo = at + edges["pos"] - edges["dhi"]
        hi = at + edges["pos"] - edges["dlo"] + length
        normal = np.flatnonzero(edges["hot"] == 0)
        if len(normal):
            bucket = (mix64(edges["a"][normal]) % np.uint64(buckets)).astype(np.int32)
            order = normal[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket, kind="stable")
            edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                rows = order[s:e]
                head = np.uint32(e - s).tobytes() + edges[rows].tobytes()
                out.append((EDGES, int(bucket[s]), head + b"".join(data[a:b].tobytes() for a, b in zip(lo[rows], hi[rows], strict=True))))
        hot = np.flatnonzero(edges["hot"])
        if len(hot):
            windows = []
            for e in hot:
                part = data[lo[e] : hi[e]]
                n = int(edges["dhi"][e]) - int(edges["dlo"][e]) + 1
                w = np.zeros(n, WINDOW)
                w["h"], w["g"] = mix64(Rolling(part, 307).fixed(length)[:n]), mix64(Rolling(part, 311).fixed(length)[:n])
                w["id"] = edges["id"][e]
                w["pos"] = int(edges["pos"][e]) - int(edges["dhi"][e]) + np.arange(n)
                w["multi"] = edges["multi"][e]
                windows.append(w)
            kept, copies = settle(np.concatenate(windows), ("h", "g"))
            out += deal(WINDOWS, kept, (kept["h"] % np.uint64(hot_buckets)).astype(np.int32)) + deal(MARKS, window_marks(copies, 1), doc_bucket(copies["id"], groups))
        return pa.Table.from_batches([batch(out)])

    edges = grouped.where(f"kind = {EDGES}").select(F.col("bucket").alias("group"), "rows")
    around = cut(texts.groupBy("bucket").cogroup(edges.groupBy("group")).applyInArrow(_guard(contexts), PACKED))
    release(spark)

    @tidied
    def compare(table: pa.Table) -> pa.Table:
        rows, left, right = [], [], []
        for packed in table.column("rows").to_pylist():
            n = int(np.frombuffer(packed[:4], np.uint32)[0])
            part = np.frombuffer(packed[4 : 4 + n * ANCHOR.itemsize], ANCHOR)
            data = np.frombuffer(packed[4 + n * ANCHOR.itemsize :], np.uint8)
            size = part["dhi"].astype(np.int64) - part["dlo"] + length
            at = np.cumsum(size) - size + part["dhi"]  # of the anchor
            col = np.arange(length - k + 1)
            before = at[:, None] - 1 - col[None, :]
            left.append(np.where(col[None, :] < part["dhi"][:, None], data[np.maximum(before, 0)], 0).astype(np.uint8))
            col = np.arange(length)
            after = at[:, None] + col[None, :]
            right.append(np.where(col[None, :] < (length - part["dlo"].astype(np.int64))[:, None], data[np.minimum(after, len(data) - 1)], 0).astype(np.uint8))
            rows.append(part)
        found = match_contexts(np.concatenate(rows), np.concatenate(left), np.concatenate(right), length)
        return pa.Table.from_batches([batch(deal(MARKS, found, doc_bucket(found["id"], groups)))])

    @tidied
    def equal_windows(table: pa.Table) -> pa.Table:
        kept, copies = settle(unpack(table.column("rows"), WINDOW), ("h", "g"))
        found = np.concatenate([window_marks(kept[kept["multi"] > 0], 0), window_marks(copies, 1)])
        return pa.Table.from_batches([batch(deal(MARKS, found, doc_bucket(found["id"], groups)))])

    ends = around.where(f"kind = {EDGES}").groupBy("bucket").applyInArrow(compare, PACKED)
    hot = around.where(f"kind = {WINDOWS}").groupBy("bucket").applyInArrow(equal_windows, PACKED)
    settled = first.where(f"kind = {MARKS}").unionByName(grouped.where(f"kind = {MARKS}")).unionByName(around.where(f"kind = {MARKS}"))
    every = cut(settled.unionByName(ends).unionByName(hot).select("bucket", "rows"))
    for done in (first, grouped, around):
        drop_cut(done)
    release(spark)
    return every, groups


def _guard(run):
    """Documents' buckets without edges have nothing to compare."""

    def guarded(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return pa.Table.from_batches([batch([])])
        return run(left, right)

    return guarded


def window_marks(rows: np.ndarray, later: int) -> np.ndarray:
    out = np.zeros(len(rows), MARK)
    out["id"], out["any"], out["later"] = rows["id"], 1, later
    out["lo"] = out["hi"] = rows["pos"]
    return out


def covered(found: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which bytes of a text of a given size its marked windows cover."""
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, found["lo"].astype(np.int64), 1)
    np.add.at(step, np.minimum(found["hi"].astype(np.int64) + length, size), -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, *, length: int = 200, k: int = 64, keep_first: bool = True, whole_characters: bool = True, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: (id, n_bytes, n_removed, spans, kept_sha256, kept), and the columns in ``keep`` as they are.

    Removes bytes covered by a string of ``length`` bytes that starts elsewhere too, in the same or another text: with
    keep_first only where an earlier start exists (texts in order of id), else everywhere. Strings are judged on the
    input and never cross texts. spans are the maximal removed runs (start, end); kept is what remains, as bytes (null
    unless with_text). whole_characters leaves in the bytes of characters that a span would cut. A null text is empty.
    A row with a null id stays as it is and matches nothing. Ids are long and stand for one text each; a repeated row is
    a copy of itself at the same place.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"keep__{c}") for c in keep])
    found, groups = repeated_windows(plain.where("id is not null"), length=length, k=k)
    extra = [f for f in plain.schema if f.name.startswith("keep__")]
    fields = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in extra)
    names = "id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept binary" + fields
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    @tidied
    def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids = part.column(0).fill_null(-1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(doc_bucket(ids, groups)), *part.columns], names=["bucket", *part.schema.names])

    @tidied
    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = unpack(right.column("rows"), MARK)
        rows = rows[rows["later"] > 0] if keep_first else rows
        rows = rows[np.argsort(rows["id"], kind="stable")]
        out: list[list] = [[], [], [], [], [], []]
        data, off = ragged(left.column("text"))
        for r, i in enumerate(left.column("id").to_pylist()):
            text = data[off[r] : off[r + 1]]
            a, b = (0, 0) if i is None else np.searchsorted(rows["id"], [i, i + 1])
            gone = covered(rows[a:b], len(text), length)
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
            if whole_characters and spans:
                spans = [x for x in (_within_characters(text, s, e) for s, e in spans) if x[0] < x[1]]
                gone = np.zeros(len(text), bool)
                for s, e in spans:
                    gone[s:e] = True
            kept = text[~gone].tobytes()
            row = (i, len(text), int(gone.sum()), [{"start": s, "end": e} for s, e in spans], hashlib.sha256(kept).hexdigest(), kept if with_text else None)
            for col, x in zip(out, row, strict=True):
                col.append(x)
        types = (pa.int64(), pa.int64(), pa.int64(), span, pa.string(), pa.binary())
        columns = [pa.array(c, t) for c, t in zip(out, types, strict=True)] + [left.column(f.name) for f in extra]
        return pa.Table.from_arrays(columns, names=["id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept", *(f.name for f in extra)])

    texts = plain.mapInArrow(pack_texts, "bucket int, id long, text string" + fields)
    out = texts.groupBy("bucket").cogroup(found.select(F.col("bucket").alias("group"), "rows").groupBy("group")).applyInArrow(finish, names)
    return out.withColumnsRenamed({f"keep__{c}": c for c in keep})


def _within_characters(text: np.ndarray, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return start, end
