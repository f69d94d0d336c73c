"""SentencePiece encoding and decoding, and token counts (operators 4 and 5).

Both cut a text before every space mark that follows another character. No piece of the model holds a mark after
another character (checked when a model is loaded), so no merge crosses such a cut and each marked word can be encoded
on its own: the ids of a text are those of its words, in order.

Encoding sorts the distinct words of a batch, which lays them out as a trie in depth-first order, and keeps the forward
table of the current word as a stack: the part that belongs to the prefix shared with the next word is reused. For a
unigram model the table holds the best score of each prefix (Viterbi). The public model is a BPE model, for which the
sum of scores isn't what the library maximises; there an edge is admissible only if the two pieces it joins stay as they
are when merged alone, which leaves one path for each prefix, and it is the library's own.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.llm.memory import tidied
from tessera.llm.sampling import fold

MARK = "▁"
_WORDS = re.compile(r" *[^ ]+| +")
#: Words longer than this are encoded but not kept in a worker's cache.
KEEP_CHARS = 40


def marked_words(text: str) -> list[str]:
    """The text's words without their first mark: "a  b" has "a" and " b"; a lone last space gives ""."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    words = text.split(" ")
    return words if "" not in words else [w[1:] for w in _WORDS.findall(" " + text)]


class Forward:
    """The forward tables of words in sorted order.

    pieces: piece -> id. scores: piece -> log probability for a unigram model, None for BPE, whose ranks are then
    ``ranks`` (lower merges first). Characters without a piece become their UTF-8 bytes' pieces, or unk.
    """

    def __init__(self, pieces: dict[str, int], scores: dict[str, float] | None = None, ranks: dict[str, float] | None = None, byte_ids: list[int] | None = None, unk: int = 0):
        self.pieces, self.scores, self.ranks, self.byte_ids, self.unk = pieces, scores, ranks, byte_ids, unk
        self.longest = max(map(len, pieces), default=1)
        self.joins: dict[tuple[str, str], bool] = {}
        self.tails: dict[str, bool] = {}
        self.word, self.last, self.best = "", [""], [0.0]
        self.floor = min(scores.values(), default=0.0) - 10 if scores is not None else 0.0

    def merged(self, text: str) -> list[str]:
        """What merging the best-ranked neighbours, leftmost first, makes of a short text."""
        parts = list(text)
        while True:
            found = min(((self.ranks[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.ranks), default=None)
            if found is None:
                return parts
            i = found[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: str, piece: str) -> bool:
        key = (left, piece)
        if (ok := self.joins.get(key)) is None:
            if len(self.joins) > 500_000:
                self.joins.clear()
            ok = self.joins[key] = self.merged(left + piece) == ([left, piece] if left else [piece])
        return ok

    def step(self, word: str, i: int) -> None:
        """Extends the table to the prefix of i characters."""
        last, pieces = self.last, self.pieces
        low = max(0, i - self.longest)
        if self.scores is not None:
            best, piece = -np.inf, ""
            for j in range(low, i):
                p = word[j:i]
                if p in pieces and (s := self.best[j] + self.scores[p]) > best:
                    best, piece = s, p
            if not piece:
                best, piece = self.best[i - 1] + self.floor, word[i - 1]
            self.best.append(best)
            last.append(piece)
            return
        joins = self.joins
        for j in range(low, i):
            p = word[j:i]
            if p in pieces:
                ok = joins.get((last[j], p))
                if self.fits(last[j], p) if ok is None else ok:
                    last.append(p)
                    return
        last.append(word[i - 1])

    def encode(self, word: str) -> list[int]:
        """Ids of one marked word; fastest if words come sorted."""
        before, step, last, get = self.word, self.step, self.last, self.pieces.get
        shared, most = 0, min(len(word), len(before))
        if before[:most] == word[:most]:
            shared = most
        else:
            while word[shared] == before[shared]:
                shared += 1
        del last[shared + 1 :], self.best[shared + 1 :]
        for i in range(shared + 1, len(word) + 1):
            step(word, i)
        self.word = word
        out: list[int] = []
        i = len(word)
        while i:
            p = last[i]
            i -= len(p)
            if (k := get(p)) is not None:
                out.append(k)
            elif self.byte_ids is not None:
                out.extend(self.byte_ids[b] for b in reversed(p.encode()))
            else:
                out.append(self.unk)
        return out[::-1]


@lru_cache(2)
def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(2)
def tables(path: str) -> tuple[dict[str, int], dict[str, float], list[int], list[bytes]]:
    """(pieces, scores, ids of bytes, what each id decodes to) of a model with byte fallback."""
    model = load(path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    if any(MARK in names[i].lstrip(MARK) for i in plain):
        raise ValueError(f"{path}: pieces span words")
    byte_ids = [0] * 256
    decoded = [b""] * n
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
            decoded[i] = bytes([int(names[i][3:5], 16)])
    for i in plain:
        decoded[i] = names[i].replace(MARK, " ").encode()
    return {names[i]: i for i in plain}, {names[i]: -model.get_score(i) for i in plain}, byte_ids, decoded


class WordIds(dict):
    """Worker cache: marked word (without its first mark) -> its ids as little-endian uint32 bytes."""

    def __init__(self, path: str, cap: int):
        pieces, ranks, byte_ids, _ = tables(path)
        ranks = {p: r for p, r in ranks.items() if len(p) > 1}
        self.forward, self.cap = Forward(pieces, ranks=ranks, byte_ids=byte_ids), cap
        self.passing: list[str] = []

    def learn(self, split: list[list[str]]) -> None:
        """Encodes the words that are new here in trie order."""
        if len(self) > self.cap:
            self.clear()
        encode = self.forward.encode
        for w in sorted(set(chain.from_iterable(split)).difference(self)):
            ids = encode(MARK + w.replace(" ", MARK) if " " in w else MARK + w)
            self[w] = array("I", ids).tobytes()
            if len(w) > KEEP_CHARS:
                self.passing.append(w)

    def forget(self) -> None:
        """Drops the long words of the texts just encoded."""
        for w in self.passing:
            del self[w]
        self.passing.clear()


@lru_cache(2)
def word_ids(path: str, cap: int) -> WordIds:
    return WordIds(path, cap)


def encode_pieces(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", cache_words: int = 300_000) -> DataFrame:
    """One row per document: (id, ids binary of little-endian uint32, decodes boolean).

    ids are the model's, without begin or end; decodes tells whether they decode to exactly the text, which is tried for
    each document and should fail only for texts that hold the mark itself. Null and empty texts have no ids. Rows keep
    their number and ids (nulls and repeats included); other columns are ignored.
    """
    ship(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, decoded = word_ids(model, cache_words), meanings(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 2500):
                part = batch.slice(at, 2500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                split = [marked_words(t) for t in texts]
                cache.learn(split)
                ids = [b"".join(map(cache.__getitem__, words)) for words in split]
                cache.forget()
                back = [x == t.encode() for x, t in zip(decode_ids(ids, decoded), texts, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(back)], names=["id", "ids", "decodes"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, ids binary, decodes boolean")


@lru_cache(2)
def meanings(path: str) -> pa.Array:
    """What each id decodes to."""
    return pa.array(tables(path)[3], pa.large_binary())


def decode_ids(ids: list[bytes], decoded: pa.Array) -> list[bytes]:
    """The texts of some documents' ids, whose first space mark isn't theirs."""
    found = decoded.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
    off = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1] if len(found) else np.zeros(1, np.int64)
    data = memoryview(found.buffers()[2] or b"") if len(found) else memoryview(b"")
    cut = off[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
    return [bytes(data[a + 1 : b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def decode_pieces(encoded: DataFrame, model: str, *, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """Texts of encode_pieces' ids: (id, text); null ids give null. Bytes that aren't UTF-8 become U+FFFD."""
    ship(encoded.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = meanings(model)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            texts = [None if x is None else t.decode("utf-8", "replace") for x, t in zip(ids, decode_ids([x or b"" for x in ids], decoded), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    plain = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, text string")


class WordLengths(dict):
    """Two tiers: a fixed table of frequent words' lengths, and the misses that this worker has met."""

    def __init__(self, path: str, frequent: dict[str, int], cap: int):
        super().__init__(frequent)
        self.model, self.frequent, self.cap = load(path), frequent, cap
        self[""] = 1

    def __missing__(self, word: str) -> int:
        n = len(self.model.encode(word))
        if len(word) <= KEEP_CHARS:
            if len(self) > self.cap:
                self.clear()
                self.update(self.frequent)
                self[""] = 1
            self[word] = n
        return n


@lru_cache(1)
def word_lengths(path: str, packed: tuple[bytes, bytes], cap: int) -> WordLengths:
    words = packed[0].decode().split("\0") if packed[0] else []
    return WordLengths(path, dict(zip(words, np.frombuffer(packed[1], np.uint16).tolist(), strict=True)), cap)


def frequent_lengths(docs: DataFrame, model: str, *, id_col: str, text_col: str, size: int, sample_docs: int) -> tuple[bytes, bytes]:
    """The compact table: at most ``size`` frequent words of at most ``sample_docs`` documents, with their lengths.

    It is a cache: what it holds changes how fast a count comes, never the count. The sampled texts meet in one task,
    which counts their words, so no word is shuffled. The table's bound is size * (KEEP_CHARS * 4 + 3)
    bytes, 6 MB at the default.
    """

    @tidied
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(w for w in marked_words(t or "") if len(w) <= KEEP_CHARS and "\0" not in w)
        top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:size]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top if w], pa.string())], names=["w"])

    sample = docs.where(fold(F.col(id_col), 61) == 17).select(F.col(text_col).cast("string").alias("text")).limit(sample_docs)
    names = [r.w for r in sample.coalesce(1).mapInArrow(words, "w string").collect()]
    lens = [len(x) for x in load(model).encode(names, num_threads=1)]
    return "\0".join(names).encode(), np.array(lens, np.uint16).tobytes()


def token_counts(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, table_size: int = 40_000, sample_docs: int = 20_000, cache_words: int = 300_000) -> DataFrame:
    """One row per document: (id, n_bytes, n_tokens, over_limit), without any shuffle of words.

    n_tokens is what the model's library gives, without begin or end; null and empty texts have 0. Rows keep their
    number and ids (nulls and repeats included); other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    packed = spark.sparkContext.broadcast(frequent_lengths(docs, model, id_col=id_col, text_col=text_col, size=table_size, sample_docs=sample_docs))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_lengths(model, packed.value, cache_words)
        look = table.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                n = [sum(map(look, marked_words(t))) if t else 0 for t in texts]
                size = [len(t.encode()) if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])], names=["id", "n_bytes", "n_tokens", "over_limit"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
