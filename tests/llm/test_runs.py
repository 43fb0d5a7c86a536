import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from colloquy.llm import queries, runs

SCHEMA = "doc_id long, text string, n_runs string"


def plain(words, least, times):
    """All maximal stretches of one period, by comparing the words with themselves at every distance."""
    w, found = np.array(words, object), {}
    for q in range(1, len(words) // times + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]]).astype(np.int8)
        begins, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for a, b in zip(begins.tolist(), ends.tolist()):
            if b - a >= (times - 1) * q and b - a + q >= least:
                found.setdefault((a, b + q), q)  # smallest period first
    return sorted((a, b - a, q) for (a, b), q in found.items())


def expected(key, text):
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text or "")
    n = len(words)
    if key is not None and n and zlib.crc32(str(key).encode()) % 10 == 0:
        g = zlib.crc32(str(key).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(plain(words, 6, 4), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (key, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed), sha(kept))


@pytest.mark.parametrize("seed", range(4))
def test_against_comparing_at_every_distance(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.choice([1, 3])):
            words = [str(rng.randrange(rng.choice([1, 2, 3, 6]))) for _ in range(rng.randrange(70))]
            if words and rng.random() < 0.5:
                at, p = rng.randrange(len(words)), rng.randrange(1, 1 + len(words))
                words = [words[at + (i - at) % p] if i >= at and at + (i - at) % p < len(words) else words[i] for i in range(len(words))]
            texts.append(words + ["x"] + words if rng.random() < 0.3 else words)
        for least, times in ((2, 2), (6, 4)):
            got = [sorted(map(tuple, g.tolist())) for g in runs.word_runs(texts, least, times)]
            assert got == [sorted(plain(w, least, times)) for w in texts]


def test_squares_that_occur_first_in_short_runs():
    words = "a b a b c d a b a b a b a b a e b a b a b a b a".split()
    assert [tuple(r) for r in runs.word_runs([words])[0].tolist()] == [(6, 9, 2), (16, 8, 2)]


def test_long_texts_take_little_more_than_linear_time():
    a, b = "a", "ab"
    while len(b) < 100_000:
        a, b = b, b + a
    assert runs.word_runs([list(b)])[0].size == 0
    assert runs.word_runs([["a", "b"] * 100_000])[0].tolist() == [[0, 200_000, 2]]
    block = [str(i) for i in range(40_001)]
    assert runs.word_runs([["x"] + block * 4 + ["1"], block])[0].tolist() == [[1, 160_004, 40_001]]


def test_batches_change_nothing(monkeypatch):
    rng = random.Random(3)
    texts = [[rng.choice("ab") for _ in range(rng.randrange(40))] for _ in range(60)]
    whole = [g.tolist() for g in runs.word_runs(texts)]
    monkeypatch.setattr(runs, "SLAB", 7)
    assert [g.tolist() for g in runs.word_runs(texts)] == whole
    assert [runs.word_runs([t])[0].tolist() for t in texts] == whole


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", "x"), (None, "no " * 9, "x"), (4, "no " * 5, "x"), (5, "no " * 6, "x"), (5, "no " * 6, "x"), (6, "q" * 30000, "x"), (7, "a a " * 7 + "b", "x")]
    rows += [(i, "w%d v u t s r q p o n m" % i, "x") for i in range(8, 60)]
    got = {(r.doc_id, *r[1:]) for r in runs.document_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {expected(key, text) for key, text, _ in rows}
    assert runs.document_runs(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.n_runs for r in runs.document_runs(spark.createDataFrame(rows[4:7], SCHEMA)).collect()] == [0, 1, 1]


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(map(tuple, queries.op12_runs(spark, sf).collect()))
    assert got == sorted(expected(r.doc_id, r.text) for r in docs)
    assert sum(r[1] for r in got) > 20
