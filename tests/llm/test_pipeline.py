import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tessera.cluster import cut as written
from tessera.llm import queries
from tests.llm.test_dedup import classes, shingles, within

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def staged(spark, docs, sf_dir, n):
    for _, f in corpus_pipeline.STAGES[:n]:
        docs = f(spark, docs, sf_dir)
        docs = written(docs)
        assert docs.columns == COLUMNS
    return docs


def test_copies_and_rows_of_one_id(spark):
    """Of linked rows the smallest stays; a repeated row is one document, another text of its id another."""
    a, b = "one two three four five six seven", "red green blue white black brown grey"
    rows = [(2, a), (1, a), (1, a), (1, b), (5, b), (None, a), (7, ""), (8, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = corpus_pipeline.ngram_jaccard_join(spark, docs.selectExpr("*", "1 as id", "2 as text_hash", "3 as component"), "").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, a), (1, b), (None, a), (7, ""), (8, None)], key=str)


def test_stages_equal_brute_force(spark):
    """Stages 2 to 5 on what stage 1 keeps, each against a plain version."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = staged(spark, docs, sf, 1).toPandas()
    assert len(kept) >= 0.97 * docs.count()
    now = {int(i): t for i, t in zip(kept["doc_id"], kept["text"], strict=True)}

    first: dict[str, tuple] = {}
    for i in sorted(now):
        for n, x in enumerate(now[i].split("\n")):
            if x.strip(" "):
                first.setdefault(x, (i, n))
    by_size: dict[int, list] = {}
    for x in first:
        by_size.setdefault(len(x.encode()), []).append(x)
    # an edit for each 20 bytes of the shorter line, two at most
    edits = lambda x, y: min(2, min(len(x.encode()), len(y.encode())) // 20)
    near = {x for x in first if len(x.encode()) >= 20 for d in range(-2, 3) for y in by_size.get(len(x.encode()) + d, []) if edits(x, y) and first[y] < first[x] and sum(abs(x.count(c) - y.count(c)) for c in "etaoin") <= 4 and within(x.encode(), y.encode(), edits(x, y))}
    after = {}
    for i, t in now.items():
        lines = t.split("\n")
        left = [x for n, x in enumerate(lines) if not x.strip(" ") or (x not in near and first[x] == (i, n))]
        if len(left) == len(lines) or "\n".join(left).strip(" "):
            after[i] = "\n".join(left)
    got = staged(spark, docs, sf, 2).toPandas()
    assert dict(zip(got["doc_id"], got["text"], strict=True)) == after
    assert (got["n_chars"] == got["text"].str.len()).all()

    sets = {i: shingles(t, 5) for i, t in after.items()}
    group = classes([(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])], sets)
    after = {i: t for i, t in after.items() if group[i] == i}
    got = staged(spark, docs, sf, 3).toPandas()
    assert dict(zip(got["doc_id"], got["text"], strict=True)) == after

    seen: set[bytes] = set()
    cut = {}
    for i in sorted(after):
        b = after[i].encode()
        gone, fresh = np.zeros(len(b), bool), []
        for s in range(len(b) - 199):
            w = b[s : s + 200]
            if w in seen:
                gone[s : s + 200] = True
            seen.add(w)
            fresh.append(w)
        for m in re.finditer(b"[\xc0-\xff][\x80-\xbf]+", b):
            if not gone[m.start() : m.end()].all():
                gone[m.start() : m.end()] = False
        text = np.frombuffer(b, np.uint8)[~gone].tobytes().decode()
        if not gone.any() or text.strip(" "):
            cut[i] = text
    got = staged(spark, docs, sf, 4).toPandas()
    assert dict(zip(got["doc_id"], got["text"], strict=True)) == cut

    lib = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    packed = corpus_pipeline.run(spark, sf).toPandas()
    want = {(i, k, zlib.crc32(np.array(ids[4096 * k : 4096 * (k + 1)], "<u4").tobytes())) for i, t in cut.items() for ids in [lib.encode(t, add_special_tokens=False).ids + [1]] for k in range(-(-len(ids) // 4096))}
    assert set(zip(packed["doc_id"], packed["piece"], packed["ids_crc32"], strict=True)) == want
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096


def test_odd_rows_pass_every_stage(spark):
    from tests.llm import corpus

    rows = [r for r in corpus.rows()]
    docs = staged(spark, corpus.crowded(corpus.table(spark)).select(*COLUMNS, "id", "h"), "", 4)
    assert set(docs.toPandas()["doc_id"].dropna()) <= {r[0] for r in rows}
    assert corpus_pipeline.STAGES[4][1](spark, docs, "").count() >= docs.count()
    assert staged(spark, corpus.empty(spark), "", 4).count() == 0


def test_registered():
    assert {q.split("_")[0] for q in queries.queries()} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.queries()) | {"pipeline"} <= set(__spark_entry__.queries())
