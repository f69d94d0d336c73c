"""Small document tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing extra columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def words(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size)}{rng.choice('abcde')}" for _ in range(n))


def rows(n: int = 40, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    passage = words(rng, 60)
    out: list[tuple] = []
    base = [words(rng, 80 + 10 * (i % 5)) for i in range(8)]
    for i in range(n):
        text = base[i % 8].split(" ")
        for _ in range(i // 8):
            text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
        text = " ".join(text)
        if i % 7 == 0:
            text = f"{words(rng, 30)} {passage} {words(rng, 20)}"
        if i % 5 == 0:
            text += "\nAll rights reserved, and the same line again and again for everyone.\n\n" + words(rng, 12)
        out.append((i, text, "en", "src0", len(text)))
    out += [
        (n, None, None, None, None), (n + 1, "", "en", "src1", 0), (n + 2, " \t\n ", "en", "src1", 4), (n + 3, "one two", "en", "src1", 7), (n + 4, "ONE Two", "en", "src1", 7),
        (n + 5, out[1][1], "en", "src1", 5), (n + 6, out[1][1], "en", "src1", 5), (n + 7, "ab " * 3000, "en", "src1", 9000), (n + 8, "日本語 テスト 🎉 naïve", "fr", "src2", 18),
        (n + 8, "日本語 テスト 🎉 naïve", "fr", "src2", 18), (n + 9, "x" * 5000, "en", "src2", 5000), (None, "no id here at all", "en", "src2", 17),
    ]
    return out


def table(spark, n: int = 40, seed: int = 1):
    return spark.createDataFrame(rows(n, seed), SCHEMA)


def crowded(df):
    """The same rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(7) for c in ("id", "rep", "h", "component", "bucket", "rows", "token", "label", "n", "line", "length")})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
