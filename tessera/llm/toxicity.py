"""Toxicity (operator 6): a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, undoes compatibility forms, look-alike letters and digits written for letters, drops zero-width
characters and turns everything but letters into single spaces. The lexicon is learnt from labelled texts: words and
word beginnings that are far more frequent in toxic than in other texts, weighted by their log odds, and exceptions,
which are a term with its left or right neighbour where that phrase isn't toxic. All patterns go into one automaton;
of overlapping matches the leftmost longest counts, so an exception takes its term's place. The score is a logistic
function of the weight found, by itself and by length.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.llm.memory import tidied

# Letters that look like Latin ones, digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
LOOK_ALIKES = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "ν": "v", "τ": "t", "υ": "u", "κ": "k", "ı": "i", "ɑ": "a", "ɡ": "g"}
_TABLE = {ord(a): b for a, b in (LOOK_ALIKES | SUBSTITUTES).items()} | dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_ASCII_TABLE = str.maketrans(SUBSTITUTES)
_NOT_ASCII_LETTERS = re.compile(r"[^a-z]+")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
SHORTEST, LONGEST = 3, 8


def fold_text(text: str) -> str:
    """" word word " in folded form, with a space at either end; " " without letters."""
    if text.isascii():
        return f" {_NOT_ASCII_LETTERS.sub(' ', text.lower().translate(_ASCII_TABLE)).strip()} "
    text = text.lower()
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return f" {_NOT_LETTERS.sub(' ', text.translate(_TABLE)).strip()} "


def terms(words: set[str]) -> set[str]:
    """Patterns that occur in a set of words: " word " for each, and " begin" for its beginnings."""
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}


@dataclass
class Lexicon:
    weights: dict[str, float]  # pattern -> weight; exceptions have 0
    coef: np.ndarray = field(default_factory=lambda: np.array([-3.0, 3.0, 0.5]))  # bias, weight, weight by length

    def matcher(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for p, w in self.weights.items():
            found.add_word(p, w)
        if self.weights:
            found.make_automaton()
        return found

    def measure(self, matcher, text: str | None) -> tuple[float, float, int]:
        """(weight found, weight per 100 words, matches)."""
        folded = fold_text(text or "")
        hits = [w for _, w in matcher.iter_long(folded) if w] if self.weights else []
        total = sum(hits)
        return min(total, 30.0), 100 * total / (folded.count(" ") + 20), len(hits)

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = self.coef[0] + rows[:, :2] @ self.coef[1:]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def surprise(a: float, b: float, n_toxic: int, n_clean: int) -> float:
    """Log-likelihood ratio of a toxic and b clean texts with a term against the same share in both."""
    share = (a + b) / (n_toxic + n_clean)
    return 2 * sum(x * np.log(x / (share * n)) for x, n in ((a, n_toxic), (b, n_clean)) if x)


def choose(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int, *, least_surprise: float, least_odds: float) -> dict[str, float]:
    """Weights of the terms kept: far likelier in toxic texts, not by chance, and the longest of equals."""
    odds = {t: np.log(((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_clean + 1))) for t, (a, b) in counts.items() if surprise(a, b, n_toxic, n_clean) >= least_surprise}
    good = {t: w for t, w in odds.items() if w >= np.log(least_odds)}
    kept: dict[str, float] = {}
    for t in sorted(good, key=lambda t: (len(t), t)):
        stem = next((t[:k] for k in range(len(t) - 1, SHORTEST, -1) if t[:k] in kept), None)
        if stem is None:
            kept[t] = good[t]
        elif counts[stem] == counts[t]:
            del kept[stem]
            kept[t] = good[t]
    return {t: round(float(w), 4) for t, w in kept.items()}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps, with classes weighted as they occur."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(b))
    penalty[0, 0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ b)
        b -= step
        if np.abs(step).max() < 1e-9:
            break
    return b


def train_lexicon(docs: DataFrame, labels: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 3000, least_surprise: float = 22.0, least_odds: float = 12.0, terms_kept: int = 20_000) -> Lexicon:
    """Learns from about ``per_class`` toxic and thrice as many other texts of labelled rows where ``learn`` holds.

    ``learn`` is a condition on labels' columns. The sample is drawn by a hash of the id and is bounded by 5 * per_class
    ids, which is what is broadcast to meet the texts. Without labels of both kinds all texts score alike.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(learn).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    totals = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if not totals.get(1) or not totals.get(0):
        return Lexicon({}, np.array([-3.0 if not totals.get(1) else 3.0, 0.0, 0.0]))
    rate = F.when(F.col("y") == 1, min(1.0, per_class / totals[1])).otherwise(min(1.0, 3 * per_class / totals[0]))
    sample = known.where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 20)) < rate * (1 << 20)).limit(5 * per_class)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id").select("y", "text")

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update(terms(set(fold_text(t or "").split())))
                seen[y][""] += 1
            names = sorted(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][t] for t in names], pa.int64()), pa.array([seen[0][t] for t in names], pa.int64())], names=["t", "a", "b"])

    # the sample is cut up by the hash of its term before it is summed, and only promising terms leave the executors
    summed = rows.mapInArrow(count, "t string, a long, b long").groupBy("t").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    got = summed.where("t = '' or (a >= 3 and a > b)").orderBy((F.col("t") != "").cast("int"), F.desc(F.col("a") - F.col("b")), "t").limit(terms_kept).collect()
    n_toxic, n_clean = next(((r.a, r.b) for r in got if r.t == ""), (0, 0))
    counts = {r.t: (r.a, r.b) for r in got if r.t}
    lexicon = Lexicon(choose(counts, n_toxic, n_clean, least_surprise=least_surprise, least_odds=least_odds))
    lexicon.weights |= exceptions(rows, lexicon)
    measured = apply(rows.select(F.col("y").alias("id"), "text"), lexicon).select("id", "weight", "density").collect()
    x = np.array([(r.weight, r.density) for r in measured]).reshape(-1, 2)
    lexicon.coef = logistic(x, np.array([r.id for r in measured], float))
    return lexicon


def exceptions(rows: DataFrame, lexicon: Lexicon, *, least_docs: int = 3, most: int = 5000) -> dict[str, float]:
    """Phrases of a term and one neighbour that clean texts hold more often than toxic ones: pattern -> 0."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded, found = fold_text(t or ""), set()
                for end, _ in matcher.iter_long(folded) if lexicon.weights else ():
                    start = folded.rfind(" ", 0, end)
                    stop = folded.find(" ", start + 1)
                    after = folded.find(" ", stop + 1)
                    before = folded.rfind(" ", 0, max(start, 0))
                    found.add(folded[start : after + 1] if after > 0 else "")
                    found.add(folded[before : stop + 1] if before >= 0 else "")
                seen[y].update(found - {""})
            names = sorted(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][t] for t in names], pa.int64()), pa.array([seen[0][t] for t in names], pa.int64())], names=["t", "a", "b"])

    summed = rows.mapInArrow(run, "t string, a long, b long").groupBy("t").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    got = summed.where(f"b >= {least_docs} and b > 2 * a").orderBy(F.desc("b"), "t").limit(most).collect()
    return {r.t: 0.0 for r in got}


def apply(docs: DataFrame, lexicon: Lexicon, *, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, weight, density, matches, score) of each row, from its text alone; a null text counts as empty."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        matcher = lexicon.matcher()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = np.array([lexicon.measure(matcher, t) for t in part.column(1).to_pylist()], float).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2].astype(np.int64)), pa.array(lexicon.score(rows))], names=["id", "weight", "density", "matches", "score"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, weight double, density double, matches long, score double")
