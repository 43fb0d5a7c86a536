import math
import random

import public_tokenizers
import sentencepiece
from colloquy.llm import queries, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_words string"


def plain():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    n = sp.get_piece_size()
    skip = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    scores = {sp.id_to_piece(i): -math.log(i + 10) for i in range(n) if not skip(i)}
    byte = -math.log(n + 10) - 4.0
    longest = max(map(len, scores))

    def count(word):
        text = "▁" + word
        best = [(0.0, 0)] + [None] * len(text)
        for e in range(1, len(text) + 1):
            size = len(text[e - 1].encode())
            options = [(best[e - 1][0] + size * byte, -(-best[e - 1][1] + size))]
            options += [(best[s][0] + scores[text[s:e]], -(-best[s][1] + 1)) for s in range(max(0, e - longest), e) if text[s:e] in scores]
            best[e] = max(options)
        return -best[-1][1]

    return count


def test_against_plain_forward_scores():
    count, rng = plain(), random.Random(4)
    words = ["", "a", "the", "theory", "theoretical", "été", "😀x", "日本語", "▁", "zzzzqqqq"] + ["".join(rng.choice("etaoin") for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    model = token_counts.Unigram(MODEL)
    model.learn(sorted(set(words)))
    assert {w: model.memo[w] for w in words} == {w: count(w) for w in words}


def test_memo_starts_afresh(monkeypatch):
    model = token_counts.Unigram(MODEL)
    want = model.count([["alpha", "beta"], ["gamma", "alpha"]])
    monkeypatch.setattr(token_counts, "MEMO", 2)
    small = token_counts.Unigram(MODEL)
    assert [small.count([w])[0] for w in (["alpha", "beta"], ["gamma", "alpha"])] == want
    assert len(small.memo) <= 4


def test_edges_and_whole_table(spark, sf):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (None, "the the", "x"), (4, "q" * 30000, "x"), (4, "q" * 30000, "x")]
    got = [tuple(r) for r in token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), MODEL).collect()]
    count = plain()
    assert got[:4] == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (None, 2, 2 * count("the"))]
    assert got[4] == got[5] and got[4][1] == 1
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), MODEL).collect() == []
    memo = {}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op7_token_counts(spark, sf).collect():
        words = (docs[r.doc_id] or "").split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(memo[w] if w in memo else memo.setdefault(w, count(w)) for w in words))
