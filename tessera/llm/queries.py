"""The operators' queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.sampling import fold


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.search import exact_top_k

    return exact_top_k(read(spark, sf_dir, "embeddings"), k=5, query_where="vec_id % 50 = 0")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.repeats import remove_repeats

    out = remove_repeats(read(spark, sf_dir, "documents"), length=200, keep_first=False, whole_characters=False, with_text=False)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.shingles import jaccard_join

    out = jaccard_join(read(spark, sf_dir, "documents"), percent=85, width=4)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_pieces, ids_crc32 (unsigned, little-endian uint32 ids), round_trip (decoding gives the text)."""
    from tessera.llm.pieces import encode_pieces

    out = encode_pieces(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return out.select(F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), F.col("decodes").alias("round_trip"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.pieces import token_counts

    return token_counts(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), limit=4096).withColumnRenamed("id", "doc_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import apply, train_lexicon

    docs = read(spark, sf_dir, "documents")
    lexicon = train_lexicon(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    out = apply(docs, lexicon, id_col="doc_id")
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "matches")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_lines, n_removed, n_near (near copies at their first place), removed (their numbers from 0, after commas)."""
    from tessera.llm.lines import dedup_lines

    out = dedup_lines(read(spark, sf_dir, "documents"), threshold=2, least_bytes=20, bytes_per_edit=20, with_text=False)
    numbers = F.array_join(F.col("removed").cast("array<string>"), ",")
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", "n_near", numbers.alias("removed"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.vectors import near_duplicates

    return near_duplicates(read(spark, sf_dir, "embeddings"), least=0.95).withColumnRenamed("id", "vec_id")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import best_fit_packing

    return best_fit_packing(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096).withColumnRenamed("id", "doc_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.langid import identify_language, train_language_model

    docs = read(spark, sf_dir, "documents")
    model = train_language_model(docs, fold(F.col("doc_id"), 4) != 2)
    out = identify_language(docs, model)
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_top_k, op2_suffix_array_dedup, op3_ngram_jaccard_join, op4_sentencepiece, op5_token_counts, op6_toxicity, op7_line_dedup, op8_embedding_near_dedup, op9_best_fit_packing, op10_language_id)}


def oracle_sql() -> dict[str, str]:
    return {}
