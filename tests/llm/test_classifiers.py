import inspect
import random
import zlib

from pyspark.sql import functions as F

from tessera.llm import queries
from tessera.llm.langid import UNDETERMINED, identify_language, train_language_model
from tessera.llm.sampling import fold
from tessera.llm.toxicity import Lexicon, apply, fold_text, train_lexicon
from tests.llm import corpus


def test_fold_is_crc32(spark):
    got = spark.createDataFrame([(i,) for i in (0, 17, 123456789, -3)], "doc_id long").select("doc_id", fold(F.col("doc_id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in got)


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert sum(r.accepted for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = train_language_model(docs, F.lit(True))
    rows = corpus.rows()
    out = identify_language(corpus.crowded(corpus.table(spark)), model, keep=("source", "h")).collect()
    assert len(out) == len(rows)
    text = {i: t for i, t, *_ in rows}
    for r in out:
        none = not any(c.isalpha() for c in text[r.id] or "")
        assert (r.lang_pred == UNDETERMINED) == none and (not none or (r.score == 0 and not r.accepted))
        assert none or r.lang_pred in model.languages
    nothing = train_language_model(corpus.empty(spark), F.lit(True))
    assert identify_language(corpus.empty(spark), nothing).count() == 0
    assert identify_language(corpus.table(spark), nothing).count() == len(rows)


def test_language_sample_is_whole():
    assert inspect.signature(train_language_model).parameters["per_language"].default == 1200


def test_noise_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train_language_model(docs, F.lit(True))
    rng = random.Random(2)
    noise = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(200)) for _ in range(20)]
    out = identify_language(spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string"), model).collect()
    assert not any(r.accepted for r in out)


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = queries.op6_toxicity(spark, sf).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in out) >= 0.97 * len(out)
    assert sum(r.predicted == 1 and r.toxic == 0 for r in out) <= 0.01 * len(out)


def learnt(spark):
    rng = random.Random(6)
    text = lambda bad: " ".join([*(f"word{rng.randrange(300)}" for _ in range(40)), *(["scumbag"] * bad)])
    rows = [(i, text(i % 3 == 0)) for i in range(600)] + [(1000 + i, text(0) + " jolly scumbag " + text(0)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0 and i < 1000)) for i, _ in rows], "doc_id long, toxic int")
    return docs, labels, train_lexicon(docs, labels, F.lit(True), least_odds=4.0)


def test_lexicon_folds_and_excepts(spark):
    lexicon = learnt(spark)[2]
    cases = ["you scumbag", "you $cumb4g", "you ѕсumbаg", "you ＳＣＵＭＢＡＧ", "you s​cumbag", "a jolly scumbag", "word1 word2 word3", "", None, "!!! ..."]
    out = apply(spark.createDataFrame(list(enumerate(cases)), "id long, text string"), lexicon).orderBy("id").collect()
    assert [r.score >= 0.5 for r in out] == [True] * 5 + [False] * 5
    assert all(0 <= r.score <= 1 for r in out)
    assert fold_text("A1b 2C!") == " aib c " and fold_text("") == "  "


def test_lexicon_does_not_depend_on_partitions(spark):
    rng = random.Random(8)
    text = lambda end: " ".join([*(f"word{rng.randrange(300)}" for _ in range(20)), end])
    ends = ["scumbag"] * 140 + ["utter scumbag"] * 60 + ["calm"] * 400 + ["utter scumbag"] * 3 + ["jolly scumbag"] * 30
    docs = spark.createDataFrame([(i, text(e)) for i, e in enumerate(ends)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(len(ends))], "doc_id long, toxic int")
    one, many = (train_lexicon(d, labels, F.lit(True), least_odds=4.0) for d in (docs.coalesce(1), docs.repartitionByRange(6, "doc_id")))
    assert one.weights == many.weights
    assert " utter scumbag " not in many.weights and many.weights[" jolly scumbag "] == 0


def test_toxicity_of_odd_rows(spark):
    lexicon = learnt(spark)[2]
    assert apply(corpus.crowded(corpus.table(spark)), lexicon, id_col="doc_id").count() == len(corpus.rows())
    none = train_lexicon(corpus.empty(spark), spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert isinstance(none, Lexicon) and apply(corpus.table(spark), none, id_col="doc_id").where("score >= 0.5").count() == 0
