"""Each registered query on the smallest tables, with its own parameters, against a plain version."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import queries
from tests.llm.test_dedup import classes, shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    return {r.vec_id: np.array(r.embedding, float) for r in rows if r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)}


def result(spark, name):
    out = queries.queries()[name](spark, SF)
    return out, out.collect()


def test_op1(spark, embeddings):
    out, got = result(spark, "op1_exact_top_k")
    assert dict(out.dtypes) | {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"} == dict(out.dtypes)
    whole = {i: np.floor(256 * v) for i, v in embeddings.items()}
    want = {}
    for i in (i for i in whole if i % 50 == 0):
        found = sorted((-int(whole[i] @ v), j) for j, v in whole.items() if j != i)[:5]
        want |= {(i, k): (j, -s) for k, (s, j) in enumerate(found, 1)}
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want


def test_op2(spark, documents):
    out, got = result(spark, "op2_suffix_array_dedup")
    assert out.dtypes[:5] == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    raw = {i: t.encode() for i, t in documents.items()}
    seen = Counter(hash(b[s : s + 200]) for b in raw.values() for s in range(len(b) - 199))
    assert len(got) == len(raw)
    for r in got:
        b = raw[r.doc_id]
        gone = np.zeros(len(b) + 1, int)
        for s in range(len(b) - 199):
            if seen[hash(b[s : s + 200])] > 1:
                gone[s] += 1
                gone[s + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_op3(spark, documents):
    out, got = result(spark, "op3_ngram_jaccard_join")
    assert out.dtypes[:3] == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    sets = {i: shingles(t, 4) for i, t in documents.items()}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= 85 * max(len(sets[a]), len(sets[b])) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = classes(links, sets)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_op4_and_op5(spark, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    ids = dict(zip(documents, model.encode(list(documents.values()), num_threads=1), strict=True))
    _, got = result(spark, "op4_sentencepiece")
    assert {r.doc_id: (r.n_pieces, r.ids_crc32) for r in got} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids.items()}
    assert all(r.round_trip or "▁" in documents[r.doc_id] for r in got)
    out, got = result(spark, "op5_token_counts")
    assert out.dtypes[:4] == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {i: (len(documents[i].encode()), len(x), len(x) > 4096) for i, x in ids.items()}


def test_op6_and_op10_contracts(spark, documents):
    fold = lambda i, n: zlib.crc32(str(i).encode()) % n
    out, got = result(spark, "op6_toxicity")
    assert out.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert len(got) == len(documents) and all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    out, got = result(spark, "op10_language_id")
    assert out.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    known = {r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang").distinct().collect()}
    for r in got:
        assert r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, documents[r.doc_id]))) and r.lang_pred in known | {"und"}


def test_scores_equal_a_plain_version(spark, documents):
    """op10's score is the calibrated softmax over averaged bucket vectors; op6's a logistic of what its lexicon finds."""
    from pyspark.sql import functions as F

    from tessera.llm.langid import features, train_language_model
    from tessera.llm.sampling import fold
    from tessera.llm.toxicity import fold_text, train_lexicon

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train_language_model(docs, fold(F.col("doc_id"), 4) != 2)
    got = {r.doc_id: (r.lang_pred, r.score) for r in result(spark, "op10_language_id")[1]}
    some = [i for i in sorted(documents) if any(map(str.isalpha, documents[i]))][:40]
    for i in some:
        raw = np.frombuffer(documents[i].encode(), np.uint8)
        (logits, _) = model.logits(raw, np.array([0, len(raw)]))
        z = logits[0] / model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        assert got[i][0] == model.languages[int(p.argmax())] and got[i][1] == pytest.approx(float(p.max()), abs=1e-6)
        assert features(raw, np.array([0, len(raw)]), 15)[0][1].sum() == pytest.approx(1, abs=1e-4)

    lexicon = train_lexicon(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold(F.col("doc_id"), 5) != 0)
    scores = {r.doc_id: (r.score, r.matches) for r in result(spark, "op6_toxicity")[1]}
    patterns = sorted(lexicon.weights, key=len, reverse=True)
    for i, text in list(documents.items())[:60]:
        folded, at, hits = fold_text(text), 0, []
        while patterns and at < len(folded):  # leftmost longest, by hand
            first = next((p for p in patterns if folded.startswith(p, at)), None)
            if first is None:
                at += 1
                continue
            if lexicon.weights[first]:
                hits.append(lexicon.weights[first])
            at += len(first)
        total = sum(hits)
        z = lexicon.coef[0] + lexicon.coef[1] * min(total, 30.0) + lexicon.coef[2] * 100 * total / (folded.count(" ") + 20)
        assert scores[i][1] == len(hits) and scores[i][0] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -50, 50))), abs=1e-9)


def test_op8(spark, embeddings):
    out, got = result(spark, "op8_embedding_near_dedup")
    assert out.dtypes[:4] == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    ids = sorted(i for i, v in embeddings.items() if np.abs(v).max(initial=0) > 0)
    unit = np.array([embeddings[i] / np.sqrt((embeddings[i] ** 2).sum()) for i in ids])
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    want = classes([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True) if a < b], ids)
    links = dict(zip(ids, near.sum(axis=1).tolist(), strict=True))
    assert all((r.n_links, r.component_id, r.kept) == (links.get(r.vec_id, 0), want.get(r.vec_id, r.vec_id), want.get(r.vec_id, r.vec_id) == r.vec_id) for r in got)


def test_op9(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    out, got = result(spark, "op9_best_fit_packing")
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    want = {}
    for i, t in documents.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        want |= {(i, k): (s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 4096))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 4096 and len(fill) <= 1.02 * sum(fill.values()) / 4096 + 1


def test_op7_is_native(spark):
    out, got = result(spark, "op7_line_dedup")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
