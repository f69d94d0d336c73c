"""Language ID (operator 10): averaged hashed subword embeddings under a linear softmax.

A text's subwords are the byte 2-, 3- and 4-grams of its words (letters only, lower case, with their word ends). Each
hashes to a row of an embedding table; a text is the average of its rows, and a linear softmax on the average gives the
language. Both are trained by stochastic gradient descent in numpy on a bounded sample. For prediction the two are
multiplied out once, so a text costs one table row per subword and language.

Rejection is calibrated on a part of the sample that training leaves out: a temperature for the softmax, the score below
which no more than ``reject_rate`` of those texts fall, and the least share of subwords that training has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.llm.memory import tidied, trim
from tessera.llm.text import chunks, ragged

UNDETERMINED = "und"
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))
CHUNK_BYTES = 1_000_000


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the two-byte capitals of Latin-1 in lower case, and everything ASCII but letters as a space."""
    kind = np.full(256, 32, np.uint8)
    kind[97:123] = np.arange(97, 123)
    kind[65:91] = np.arange(97, 123)
    kind[128:] = np.arange(128, 256)
    out = kind[data]
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][capital] += 32
    return out


def subwords(data: np.ndarray, off: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """For each n, the bucket of the n-gram at every byte; 2**bits where there is none (text end, inner blanks)."""
    folded = letters(data).astype(np.uint32)
    blank = folded == 32
    left = np.repeat(off[1:], np.diff(off)) - np.arange(len(data))
    for n in (2, 3, 4):
        m = len(data) - n + 1
        out = np.full(len(data), 1 << bits, np.int64)
        if m > 0:
            h = np.full(m, n * 0x165667B1 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                h = (h ^ folded[j : j + m]) * _MULTIPLIERS[j]
            none = left[:m] < n
            for j in range(1, n - 1):
                none |= blank[j : j + m]
            none |= blank[:m] & blank[n - 1 :]
            out[:m] = np.where(none, 1 << bits, h >> np.uint32(32 - bits))
        yield out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (languages, 2**bits + 1): what a subword adds to each logit
    bias: np.ndarray
    seen: np.ndarray  # 1 where training met the bucket
    bits: int
    temperature: float = 1.0
    least_score: float = 0.0
    least_seen: float = 0.0

    def logits(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logits, share of subwords seen) of each text; texts without subwords have the bias and share 0."""
        n = len(off) - 1
        sums, known, total = np.zeros((n, len(self.languages))), np.zeros(n), np.zeros(n)
        rows = np.flatnonzero(np.diff(off))
        if len(rows):
            starts = off[rows]
            for idx in subwords(data, off, self.bits):
                total[rows] += np.add.reduceat((idx < 1 << self.bits).astype(np.float64), starts)
                known[rows] += np.add.reduceat(self.seen[idx], starts)
                for k in range(len(self.languages)):
                    sums[rows, k] += np.add.reduceat(self.table[k][idx], starts)
        return sums / np.maximum(total, 1)[:, None] + self.bias, known / np.maximum(total, 1)

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def features(data: np.ndarray, off: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: (distinct buckets, share of each)."""
    per_n = list(subwords(data, off, bits))
    out = []
    for a, b in zip(off[:-1], off[1:], strict=True):
        idx, n = np.unique(np.concatenate([x[a:b] for x in per_n]), return_counts=True)
        keep = idx < 1 << bits
        n = n[keep].astype(np.float64)
        out.append((idx[keep].astype(np.int32), n / max(n.sum(), 1)))
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], *, bits: int, dim: int = 16, epochs: int = 8, rate: float = 0.6, reject_rate: float = 0.001, seed: int = 7) -> Model:
    """Trains on four fifths of the rows and calibrates on the rest (on all, under 50 rows)."""
    languages = sorted(set(labels)) or [UNDETERMINED]
    at = {x: i for i, x in enumerate(languages)}
    y = np.array([at[x] for x in labels], np.int64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    cut = len(rows) // 5 if len(rows) >= 50 else 0
    held, train = (order[:cut], order[cut:]) if cut else (order, order)
    embed = rng.normal(0, 0.1, (1 << bits, dim))
    out, bias = np.zeros((dim, len(languages))), np.zeros(len(languages))
    seen = np.zeros((1 << bits) + 1)
    weight = len(train) / np.maximum(1, np.bincount(y[train], minlength=len(languages))) / len(languages) if len(train) else np.ones(len(languages))
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        for i in rng.permutation(train):
            idx, share = rows[i]
            if not len(idx):
                continue
            seen[idx] = 1
            mean = share @ embed[idx]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= min(4.0, weight[y[i]])
            back = out @ p
            out -= lr * np.outer(mean, p)
            bias -= lr * 0.1 * p
            embed[idx] -= lr * 50 * share[:, None] * back
    table = np.zeros((len(languages), (1 << bits) + 1))
    table[:, :-1] = (embed @ out).T
    model = Model(languages, table, bias, seen, bits)
    if len(held):
        logits = np.array([table[:, idx] @ share + bias for idx, share in (rows[i] for i in held)])
        known = np.array([share @ seen[idx] for idx, share in (rows[i] for i in held)])
        best = np.inf
        for t in np.geomspace(0.1, 10, 41):
            model.temperature = t
            loss = -np.log(np.maximum(1e-12, model.probabilities(logits)[np.arange(len(held)), y[held]])).mean()
            if loss < best - 1e-9:
                best, chosen = loss, t
        model.temperature = chosen
        top = model.probabilities(logits).max(axis=1)
        model.least_score = min(0.5, 0.9 * float(np.quantile(top, reject_rate)))
        model.least_seen = 0.5 * float(np.quantile(known, reject_rate))
    return model


def train_language_model(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 1200, texts: int = 240_000, languages: int = 10_000, bits: int = 15, reject_rate: float = 0.001) -> Model:
    """Fits on about per_language texts of each language among rows where ``learn`` holds, about ``texts`` in all.

    With more than texts / per_language languages each has an even share of ``texts``, 16 at least. Labels beyond the
    most frequent ``languages``, more than there are codes for, can't be predicted. The sample is drawn by a hash of the
    id at a rate set from each language's count, so it is bounded by 1.5 * max(texts, 16 * languages) texts, whole ones,
    of which only bucket shares reach the driver.
    """
    ship(docs.sparkSession)
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), learn.alias("learn")).where("learn and lang is not null and text is not null")
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return fit([], [], bits=bits)
    per_language = min(per_language, max(16, texts // len(counts)))
    rates = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"])))])
    sample = usable.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 20)) < rates[F.col("lang")] * (1 << 20))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = ragged(batch.column(0))
            for i, j in chunks(off, CHUNK_BYTES):
                rows = features(data[off[i] : off[j]], off[i : j + 1] - off[i], bits)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), pa.array([a.tobytes() for a, _ in rows], pa.binary()), pa.array([b.astype(np.float32).tobytes() for _, b in rows], pa.binary())], names=["lang", "idx", "share"])

    most = int(1.5 * per_language * len(counts))
    got = sample.select("text", "lang").mapInArrow(run, "lang string, idx binary, share binary").limit(most).collect()
    got.sort(key=lambda r: (r.lang, bytes(r.idx), bytes(r.share)))
    rows = [(np.frombuffer(r.idx, np.int32), np.frombuffer(r.share, np.float32)) for r in got]
    labels = [r.lang for r in got]
    del got
    model = fit(rows, labels, bits=bits, reject_rate=reject_rate)
    del rows
    trim()
    return model


def identify_language(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Adds to (id, *keep): lang_pred, score, accepted.

    lang_pred is the likeliest language and score its calibrated probability; a null text or one without any letter is
    ``und`` with score 0. accepted is false for those, for scores below the calibrated least and for texts of whose
    subwords too few were seen in training. Rows keep their number and ids (nulls and repeats included).
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        plain = np.zeros(256, np.float64)
        plain[65:91] = plain[97:123] = 1
        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            data, off = ragged(col)
            for i, j in chunks(off, CHUNK_BYTES):
                part, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
                p = model.probabilities((out := model.logits(part, at))[0])
                best, top, seen = p.argmax(axis=1), p.max(axis=1), out[1]
                ok = np.zeros(j - i, bool)
                rows = np.flatnonzero(np.diff(at))
                if len(rows):
                    ok[rows] = np.add.reduceat(plain[part], at[rows]) > 0
                for r in np.flatnonzero(~ok):
                    ok[r] = any(map(str.isalpha, col[i + int(r)].as_py() or ""))
                lang = [model.languages[b] if good else UNDETERMINED for b, good in zip(best.tolist(), ok.tolist(), strict=True)]
                top = np.where(ok, top, 0.0)
                accepted = ok & (top >= model.least_score) & (seen >= model.least_seen)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)), pa.array(lang, pa.string()), pa.array(top), pa.array(accepted)], names=[*batch.schema.names[:-1], "lang_pred", "score", "accepted"])

    plain = docs.select(F.col(id_col).alias("id"), *keep, F.col(text_col).cast("string").alias("text__"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != "text__")
    return plain.mapInArrow(run, f"{fields}, lang_pred string, score double, accepted boolean")
