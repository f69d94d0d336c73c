"""A training corpus from documents: language, lines, near copies, repeated passages, packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return the
columns of documents, with n_chars brought up to date where the text changed. SQL can't express the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.cluster import cut, drop_cut, release
from tessera.llm.langid import identify_language, train_language_model
from tessera.llm.lines import dedup_lines
from tessera.llm.packing import best_fit_packing
from tessera.llm.queries import vocabulary
from tessera.llm.repeats import remove_repeats
from tessera.llm.sampling import fold
from tessera.llm.shingles import jaccard_join

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def with_text(docs: DataFrame, changed: str) -> DataFrame:
    """Columns of documents; rows whose text was changed to blank go, n_chars follows changed texts, others stay as they are."""
    left = docs.where(f"not coalesce({changed}, false) or trim(coalesce(text, '')) <> ''")
    return left.withColumn("n_chars", F.when(F.expr(changed), F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters (null and empty texts too) and those whose language the calibrated model rejects."""
    model = train_language_model(docs, fold(F.col("doc_id"), 4) != 2)
    return identify_language(docs, model, keep=COLUMNS).where("accepted").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that come earlier, exactly or within two edits (20 bytes for each); documents of nothing but such lines go.

    Rows of null text or null id stay as they are; a repeated row keeps what its first copy keeps.
    """
    return with_text(dedup_lines(docs, threshold=2, least_bytes=20, bytes_per_edit=20), "n_removed > 0")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by Jaccard >= 0.8 over five-word shingles: the smallest (doc_id, text hash).

    Documents without words, and rows with a null id, stay. Repeated rows (equal doc_id and text) are one document; rows
    of one doc_id with other texts are others.
    """
    linked = cut(jaccard_join(docs, percent=80, width=5))
    first = linked.where("component is not null").groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("first"))
    gone = linked.join(first, "component").where(F.struct("id", "text_hash") > F.col("first")).select("id", "text_hash").distinct()
    own = docs.withColumn("hash__", F.xxhash64("text"))
    same = lambda t: (own["doc_id"] == t["id"]) & (own["hash__"] == t["text_hash"])
    kept = own.join(gone, same(gone), "left_anti")
    again = linked.where("id is not null").groupBy("id", "text_hash").count().where("count > 1").select("id", "text_hash")
    if again.limit(1).count():
        once = kept.where("doc_id is not null").dropDuplicates(["doc_id", "hash__"])
        kept = once.unionByName(kept.where("doc_id is null"))
    return kept.select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out strings of 200 bytes or more that have an earlier copy, in whole characters."""
    rest = tuple(c for c in COLUMNS if c not in ("doc_id", "text"))
    out = remove_repeats(docs, length=200, keep_first=True, keep=("text", *rest))
    return with_text(out.withColumnRenamed("id", "doc_id").withColumn("text", F.when(F.col("n_removed") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))), "n_removed > 0")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in sequences of at most 4096; a null or empty text is one piece of the end mark."""
    return best_fit_packing(docs, vocabulary("word_bpe_49k.json"), capacity=4096).withColumnRenamed("id", "doc_id")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("ngram_jaccard_join", ngram_jaccard_join), ("suffix_array_dedup", suffix_array_dedup), ("best_fit_packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        if i:
            drop_cut(before)
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
