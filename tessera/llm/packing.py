"""Best-fit packing of documents into sequences (operator 9) by the sum of squares of open bins per gap."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, ship
from tessera.llm.memory import tidied

# Up to U+024F every text is in NFC, but for one letter Python's lower case is the tokenizer's, and its letters, numbers
# and spaces can be listed; no two alternatives start alike, so the commonest comes first.
_BEYOND = re.compile("[^\0-\u012f\u0131-\u024f]")
_LETTERS, _NUMBERS = "a-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼-¾"
_LATIN = re.compile(f"[{_LETTERS}]+|[{_NUMBERS}]|'s|'t|'re|'ve|'m|'ll|'d|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+")
KEEP_CHARS = 40


class WordTokens(dict):
    """Worker cache of a word-level BPE tokenizer: word -> its ids as little-endian uint32 bytes.

    Two generations of at most ``cap`` words each: when the younger is full it becomes the older, and words met again
    move over, so frequent words are never encoded twice.
    """

    def __init__(self, path: str, cap: int):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.cap, self.older = Tokenizer.from_file(path), cap, {}
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^ \p{L}\p{N}]+").findall
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, new: list[str]) -> None:
        """Encodes distinct new words many at a time: the piece that ends a word is marked as such in the vocabulary."""
        texts = [" ".join(new[i : i + 400]) for i in range(0, len(new), 400)]
        for i, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            part = new[400 * i : 400 * (i + 1)]
            ids = np.array(e.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) == len(part):
                flat, lo = ids.tobytes(), 0
                for w, hi in zip(part, ends, strict=True):
                    self[w] = flat[lo:hi]
                    lo = hi
            else:  # a word that the tokenizer splits once more, or drops
                for w in part:
                    self[w] = self.whole(w)

    def split(self, text: str) -> list[str]:
        if _BEYOND.search(text) is None:
            return _LATIN.findall(text.lower())
        return self.words(self.tokenizer.normalizer.normalize_str(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if any(s in t for s in self.special) else self.split(t) for t in texts]
        if len(self) > self.cap:
            self.older = dict(self)
            self.clear()
        new = set(chain.from_iterable(x for x in split if x)).difference(self)
        known = new.intersection(self.older)
        self.update({w: self.older[w] for w in known})
        new -= known
        self.learn(list(new))
        out = [self.whole(t) if x is None else b"".join(map(self.__getitem__, x)) for x, t in zip(split, texts, strict=True)]
        for w in new:
            if len(w) > KEEP_CHARS:
                del self[w]
        return out


@lru_cache(1)
def word_tokens(path: str, cap: int) -> WordTokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(path, cap)


def token_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, cache_words: int = 150_000) -> DataFrame:
    """Pieces of at most ``capacity`` ids: (id, piece, start, length, ids_crc32). A document's ids end with end_id.

    Null and empty texts are one piece of end_id alone. The tokenizer is one that lower-cases and splits into words
    (NFC, white space, the word pattern above); its special strings inside texts become their own ids.
    """
    ship(docs.sparkSession)
    tail = np.array([end_id], "<u4").tobytes()

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_tokens(tokenizer, cache_words)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows: list[list] = [[], [], [], [], []]
                keys = part.column(0).to_pylist()
                for key, ids in zip(keys, cache.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids += tail
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        one = ids[start : start + 4 * capacity]
                        for col, x in zip(rows, (key, k, start // 4, len(one) // 4, zlib.crc32(one)), strict=True):
                            col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], part.column(0).type), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:])], names=["id", "piece", "start", "length", "ids_crc32"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places items in the given order: (bin, offset) of each and the fill of each bin.

    An item of length s may go to an open bin of any residual gap g >= s or to a new one; it goes where the sum over g of
    the squared number of open bins of gap g grows least, ties to the smallest gap. Full bins aren't open.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    barred = np.int64(1) << 40
    for i, s in enumerate(lengths.tolist()):
        # leaving gap g: 1 - 2 N(g), only where N(g) > 0; arriving at g - s: 2 N(g - s) + 1, nothing at gap 0
        leave = np.where(count[s:] > 0, 1 - 2 * count[s:], barred)
        arrive = 2 * count[: capacity + 1 - s] + 1
        arrive[0] = 0
        leave[-1] = 0  # a new bin
        g = int(np.argmin(leave + arrive)) + s
        if g == capacity:
            b, at = len(fill), 0
            fill.append(0)
        else:
            b = open_bins[g].pop()
            count[g] -= 1
            at = capacity - g
        where[i], offset[i] = b, at
        fill[b] += s
        if g > s:
            open_bins[g - s].append(b)
            count[g - s] += 1
    return where, offset, np.array(fill, np.int64)


def small_last(length: np.ndarray, share: float) -> np.ndarray:
    """An order that leaves the smallest ``share`` of the items for the end, longest first: they fill what is left open."""
    order = np.argsort(length, kind="stable")
    k = int(len(length) * share)
    return np.concatenate([np.sort(order[k:]), order[:k][::-1]])


def pack_pieces(pieces: DataFrame, *, capacity: int = 4096, per_task: int = 60_000, fan_in: int = 16, loose: float = 0.995) -> DataFrame:
    """Adds (sequence_id, offset) to pieces with a ``length`` of at most ``capacity``.

    Pieces are dealt by a hash of their columns to tasks of about ``per_task``; each packs its own in hash order, which
    is as good as random and the same in every attempt, and the smallest tenth last. Of the sequences that a task leaves
    less than ``loose`` full, the emptiest go on to the next round, where ``fan_in`` tasks' rests meet in one, until one
    task holds the last rests and keeps the best of three orders. A task passes on at most per_task / fan_in pieces, so
    every task of every round is bounded; where lengths leave more gaps than that (say all are 2,500 of 4,096), the
    fuller sequences stay as they are. A null or zero length counts as 1, the end mark; repeated rows are pieces of
    their own; no pieces give no sequences.
    """
    spark = pieces.sparkSession
    ship(spark)
    names = pieces.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def packer(last: bool, level: int):
        @tidied
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["hash__", *names], kind="stable", ignore_index=True)
            length = rows["length"].to_numpy()
            tried = [(order, sum_of_squares(length[order], capacity)) for order in (small_last(length, q) for q in ((0.1, 0.25, 1.0) if last else (0.1,)))]
            order, (where, offset, fill) = min(tried, key=lambda t: len(t[1][2]))
            done = (fill >= loose * capacity) | last
            if not last:
                emptiest = np.argsort(fill, kind="stable")
                held = np.cumsum(np.bincount(where, minlength=len(fill))[emptiest])
                done[emptiest[held > max(1, per_task // fan_in)]] = True
            return rows.iloc[order].assign(sequence_id=(np.int64(level) << 58) + (np.int64(key[0]) << 32) + where, offset=offset, done=done[where])

        return run

    todo = cut(pieces.withColumn("length", F.greatest(F.coalesce("length", F.lit(1)), F.lit(1)).cast("long")))
    tasks = max(1, -(-todo.count() // per_task))
    todo = todo.withColumn("hash__", F.xxhash64(*names)).withColumn("task__", F.pmod("hash__", F.lit(tasks)))
    placed, level = None, 0
    while True:
        last = tasks == 1
        packed = todo.groupBy("task__").applyInPandas(packer(last, level), f"{fields}, hash__ long, task__ long, sequence_id long, offset long, done boolean")
        if last and placed is None:
            return packed.select(*names, "sequence_id", "offset")
        packed = cut(packed)
        closed = packed.where("done").select(*names, "sequence_id", "offset")
        placed = closed if placed is None else placed.unionByName(closed)
        if last:
            return placed
        tasks, level = -(-tasks // fan_in), level + 1
        todo = packed.where("not done").select(*names, "hash__", F.pmod("task__", F.lit(tasks)).alias("task__"))


def best_fit_packing(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, **names: str) -> DataFrame:
    """Tokenizes and packs: (id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack_pieces(token_pieces(docs, tokenizer, capacity=capacity, **names), capacity=capacity)
