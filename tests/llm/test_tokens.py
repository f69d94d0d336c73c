import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.packing import best_fit_packing, pack_pieces, sum_of_squares, word_tokens
from tessera.llm.pieces import MARK, Forward, decode_pieces, encode_pieces, load, marked_words, token_counts
from tests.llm import corpus

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_counts_and_ids_are_the_librarys(spark):
    docs = corpus.crowded(corpus.table(spark))
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts = token_counts(docs, MODEL, limit=100, table_size=50).collect()
    encoded = encode_pieces(docs, MODEL).collect()
    want = {i: lib.encode(t or "") for i, t, *_ in corpus.rows()}
    assert len(counts) == len(encoded) == len(corpus.rows())
    for r in counts:
        assert (r.n_tokens, r.over_limit) == (len(want[r.id]), len(want[r.id]) > 100)
    for r in encoded:
        assert np.frombuffer(r.ids, "<u4").tolist() == want[r.id] and r.decodes


def test_decoding_is_the_inverse(spark):
    docs = corpus.table(spark)
    back = decode_pieces(encode_pieces(docs, MODEL), MODEL)
    assert sorted(map(str, back.select("id", "text").collect())) == sorted(map(str, docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).collect()))


def test_empty_tables(spark):
    docs = corpus.empty(spark)
    assert token_counts(docs, MODEL).count() == encode_pieces(docs, MODEL).count() == best_fit_packing(docs, WORDS).count() == 0


@settings(deadline=None, max_examples=80)
@given(st.text(max_size=60))
def test_marked_words_cut_where_no_merge_crosses(text):
    lib = load(MODEL)
    total = sum(1 if w == "" else len(lib.encode(w)) for w in marked_words(text))
    assert total == len(lib.encode(text))


def brute_viterbi(word, scores):
    best = {0: (0.0, [])}
    for i in range(1, len(word) + 1):
        found = [(best[j][0] + scores[word[j:i]], best[j][1] + [word[j:i]]) for j in range(i) if j in best and word[j:i] in scores]
        if found:
            best[i] = max(found, key=lambda x: x[0])
    return best[len(word)][1]


def test_unigram_tables_shared_by_sorted_words_give_viterbi():
    rng = random.Random(3)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(60)} | set("abc"))
    scores = {p: -rng.random() * 5 - len(p) * 0.1 for p in pieces}
    ids = {p: i for i, p in enumerate(pieces)}
    forward = Forward(ids, scores=scores)
    for w in sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(200)}):
        got = forward.encode(w)
        want = brute_viterbi(w, scores)
        assert "".join(pieces[i] for i in got) == w
        assert sum(scores[pieces[i]] for i in got) == pytest.approx(sum(scores[p] for p in want))


def test_word_tokens_equal_the_library():
    texts = [t or "" for _, t, *_ in corpus.rows()] + ["a<|endoftext|>B", "İstanbul ΣΑΣ é x\x1cy \x85 k", "it's I'LL ___ a_b ² ½ ª ÀÉß", "٠ 5½ ʼn", "  "]
    lib = Tokenizer.from_file(WORDS)
    got = word_tokens(WORDS, 1000).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_is_gapless_and_complete(spark):
    capacity = 64
    packed = best_fit_packing(corpus.crowded(corpus.table(spark)), WORDS, capacity=capacity).toPandas()
    lib = Tokenizer.from_file(WORDS)
    import zlib

    want = sorted((-1 if i is None else i, len(lib.encode(t or "", add_special_tokens=False).ids) + 1) for i, t, *_ in corpus.rows())
    got = packed.assign(doc=packed["id"].fillna(-1).astype(int))
    twice = {i for i, _ in want if sum(j == i for j, _ in want) > 1}
    for i, n in want:
        mine = got[got["doc"] == i]
        assert mine["length"].sum() == n * (2 if i in twice else 1)
        assert (mine["start"] == mine["piece"] * capacity).all()
    for _, seq in packed.sort_values("offset").groupby("sequence_id"):
        assert seq["offset"].tolist() == np.concatenate([[0], np.cumsum(seq["length"])[:-1]]).tolist()
        assert seq["length"].sum() <= capacity
    one = next(r for r in corpus.rows() if r[0] == 3)
    ids = lib.encode(one[1], add_special_tokens=False).ids + [1]
    first = got[(got["doc"] == 3) & (got["piece"] == 0)].iloc[0]
    assert first["ids_crc32"] == zlib.crc32(np.array(ids[:capacity], "<u4").tobytes())


def test_rounds_of_packing_waste_little(spark):
    rng = np.random.default_rng(5)
    lengths = np.clip(rng.exponential(200, 4000).astype(int), 1, 1000).tolist()
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long")
    packed = pack_pieces(pieces, capacity=1000, per_task=300, fan_in=4).toPandas()
    assert sorted(packed["id"]) == list(range(4000))
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1000
    assert packed["sequence_id"].nunique() <= 1.01 * sum(lengths) / 1000 + 1


def test_sum_of_squares_takes_the_smallest_growth():
    lengths = np.random.default_rng(2).integers(1, 20, 300)
    where, offset, fill = sum_of_squares(lengths, 20)
    bins: list[int] = []
    for s, b in zip(lengths, where, strict=True):
        gaps = [20 - f for f in bins]
        count = {g: gaps.count(g) for g in set(gaps) if g}

        def cost(g):
            after = dict(count)
            if g != 20:
                after[g] -= 1
            if g > s:
                after[g - s] = after.get(g - s, 0) + 1
            return sum(v * v for v in after.values())

        options = {g: cost(g) for g in {*count, 20} if g >= s}
        chosen = 20 - bins[b] if b < len(bins) else 20
        assert options[chosen] == min(options.values())
        if b < len(bins):
            bins[b] += s
        else:
            bins.append(int(s))
    assert fill.tolist() == bins


def test_a_mark_in_a_text_is_reported(spark):
    docs = spark.createDataFrame([(1, f"a{MARK}b")], "doc_id long, text string")
    assert not encode_pieces(docs, MODEL).collect()[0].decodes


def test_round_trip_is_tried_on_whole_documents(spark, monkeypatch):
    def lossy(text):
        return marked_words(text)[:-1] if text.startswith("short") else marked_words(text)

    monkeypatch.setattr("tessera.llm.pieces.marked_words", lossy)
    docs = spark.createDataFrame([(1, "a whole text"), (2, "short of a word"), (3, ""), (4, None), (5, "naïve 🎉  two ")], "doc_id long, text string")
    assert {r.id: r.decodes for r in encode_pieces(docs, MODEL).collect()} == {1: True, 2: False, 3: True, 4: True, 5: True}


def test_packing_of_equal_lengths_bounds_every_task(spark):
    """Pieces that no two of fit in a sequence aren't carried on beyond a task's share."""
    from pyspark.sql import functions as F

    from tessera.llm.packing import pack_pieces

    pieces = spark.range(6000).select(F.col("id"), F.lit(0).alias("piece"), (2500 + F.col("id") % 7).alias("length"))
    out = pack_pieces(pieces, per_task=500, fan_in=4)
    got = out.toPandas()
    assert len(got) == 6000 and got["sequence_id"].nunique() == 6000 and (got["offset"] == 0).all()
    rounds = (got["sequence_id"] // (1 << 58)).value_counts().to_dict()
    assert rounds[0] >= 6000 - 12 * 125 and max(v for k, v in rounds.items() if k) <= 12 * 125
