import hashlib
import random

import numpy as np
from colloquy.llm import queries, suffix

SCHEMA = "doc_id long, text string, places string, digest string"


def plain(texts):
    """Per text: bytes, removed, runs, digest of the rest; by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for p in range(len(d) - 199):
            w = d[p : p + 200]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - 199):
            if seen[d[p : p + 200]] > 1:
                gone[p : p + 200] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts):
    df = spark.createDataFrame([(i, t, "p", "d") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.removals(df).collect()}
    for i, want in enumerate(plain(texts)):
        assert got[i] == want, i


def words(rng, n):
    return "".join(rng.choice("abcdeéfgh ") for _ in range(n))


def test_random_repeats(spark):
    rng = random.Random(8)
    shared = [words(rng, n) for n in (199, 200, 201, 202, 207, 208, 230, 300, 420, 900)]
    texts = [None, "", "a" * 199, "a" * 200, "a" * 201, "ab" * 300, "abc" * 90, "a" * 1000]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(words(rng, rng.randrange(0, 260)))
            s = rng.choice(shared)
            a = rng.randrange(0, 120)
            parts.append(s[a:] if rng.random() < 0.5 else s[: len(s) - a])
        texts.append("".join(parts))
    texts += [texts[-1], texts[-1], texts[-2]]
    base = words(rng, 2500)
    for _ in range(25):
        b = list(base)
        for _ in range(rng.randrange(0, 9)):
            b[rng.randrange(len(b))] = rng.choice("xyz")
        texts.append("".join(b))
    check(spark, texts)


def test_segments(spark, monkeypatch):
    # Texts longer than a segment give the same anchors and buckets as whole ones.
    rng = random.Random(2)
    data = (words(rng, 3000) + "q" * 400 + words(rng, 1000)).encode()
    whole = suffix.anchors(data)
    monkeypatch.setattr(suffix, "SEGMENT", 500)
    parts = suffix.anchors(data)
    at = lambda a: sorted({(p >> 16) + (p >> 8 & 255) for p in a["place"].tolist()})
    assert at(whole) == at(parts)
    windows = lambda a: sorted((p >> 16) + k for p in a["place"].tolist() for k in range((p & 255) + 1))
    assert windows(parts) == windows(whole) == list(range(len(data) - 199))
    which, number, position, least, most = suffix.grids(parts["place"])
    starts = [p - u for p, a, b in zip(position.tolist(), least.tolist(), most.tolist()) for u in range(a, b + 1)]
    assert sorted(starts) == list(range(len(data) - 199))
    assert position.min() >= 0 and position.max() + suffix.START <= len(data)


def test_doubling_ranks_by_names(spark):
    # Positions 16 bytes apart in two strings that part after 100 bytes: pairs are left where 128 and 176 bytes may repeat.
    from colloquy.llm.store import Store

    rng = np.random.default_rng(3)
    a = rng.integers(97, 123, 800).astype(np.uint8)
    b = np.concatenate((a[:100], rng.integers(97, 123, 300).astype(np.uint8), a[400:]))
    rows, last = [], (800 - 64) // 16
    for anchor, data in enumerate((a, b)):
        at = 16 * np.arange(last + 1)
        names = [suffix.Names(data, k).of(at, at + 64).view(np.int64).tolist() for k in (0, 1)]
        rows += [(x, y, anchor << 6 | i) for i, (x, y) in enumerate(zip(*names))]
    pairs = spark.createDataFrame(rows, "n0 long, n1 long, id long")
    key, store, same = ["n0", "n1"], Store(spark, "t"), lambda i, n: 16 * i + n <= 800 and (a[16 * i : 16 * i + n] == b[16 * i : 16 * i + n]).all()
    for step, half in zip(suffix.STEPS, (64, 128)):
        pairs, key = suffix._ranked_pairs(pairs, key, step // 16, store), ["first", "second"]
        got = {(r.id & 63) for r in pairs.collect()}
        # A pair is left where both of its halves repeat; it is ranked as a whole in the next round.
        assert got == {i for i in range(last + 1) if same(i, half) and same(i + step // 16, half)}


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op3_suffix(spark, sf).collect()}
    want = plain([d.text for d in docs])
    assert {d.doc_id: w for d, w in zip(docs, want)} == got


def test_rows_and_empty(spark):
    rows = [(1, "z" * 250, "p", "d"), (1, "z" * 250, "p", "d"), (None, "short", "p", "d"), (None, "y" * 199 + "é", None, "d")]
    got = sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in suffix.removals(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0, 0), (0, 0, 0), (1, 250, 1), (1, 250, 1)]
    assert suffix.removals(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cut_texts(spark):
    rng = random.Random(1)
    one = "é" * 150
    rows = [(1, words(rng, 100) + "-" + one + "-tail", "p", "d"), (2, one + "+" + words(rng, 90), "p", "d"), (3, None, "p", "d")]
    got = suffix.cut_texts(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "places", "digest"]
    by = {r.doc_id: r.text for r in got.collect()}
    assert by[1] == rows[0][1].replace(one, "") and by[2] == rows[1][1].replace(one, "") and by[3] is None
