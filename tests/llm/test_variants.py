import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from colloquy.llm import queries, variants

SCHEMA = "doc_id long, text string, n string"


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, plant=True):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if plant and h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain(rows, pairs=None, plant=True):
    n = counted(rows, plant)
    near = defaultdict(list)
    for a, b in pairs(n) if pairs else ((a, b) for a in n for b in n if a < b):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def halves(n):
    """Words within one letter agree in their first or in their last half, at one of three shifts."""
    groups = defaultdict(set)
    for w in n:
        for size in (len(w) - 1, len(w), len(w) + 1):
            k = size // 2
            groups["a", size, w[:k]].add(w)
            groups["z", size, w[len(w) - k + 1 :]].add(w)
    return {(a, b) for group in groups.values() for a in group for b in group if a < b and abs(len(a) - len(b)) < 2}


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))) for _ in range(260)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(120)]
    got = variants.spelling_variants(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) > 100 and set(found) == plain(rows)


def test_keys_meet_exactly_where_texts_do():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(2, 8))) for _ in range(90)})
    key, index, place, kind = variants.deletion_keys(words, 2)
    texts = {}
    for k, i, p, t in zip(key.tolist(), index.tolist(), place.tolist(), kind.tolist()):
        w = words[i]
        text = (t, w, None) if p < 0 else (t, w[:p] + w[p + 1 :], None if t else (p, len(w)))
        assert texts.setdefault(k, text) == text
    assert len(set(texts.values())) == len(texts)


def test_collisions_of_keys_link_nothing(spark, monkeypatch):
    rows = [(i, "alpha alpho brave bravo quiet quite alphas") for i in range(9)] + [(9, "alpha brave brave")]
    want = plain(rows)
    shared = variants._shared
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    words = variants.count_words(docs, 5).groupBy("word").sum("n").collect()
    assert {w: n for w, n in words if n >= 3} == counted(rows)
    monkeypatch.setattr(variants, "_shared", lambda frame: shared(frame.withColumn("key", frame["key"].bitwiseAND(3))))
    assert set(map(tuple, variants.spelling_variants(docs).collect())) == want


def test_roots_follow_forms(spark):
    text = "abcde " * 40 + "abcdf " * 20 + "abcgf " * 10 + "abhgf " * 5 + "aihgf aihgf aihgf"
    got = {r.word: (r.form, r.root, r.form_n) for r in variants.spelling_variants(spark.createDataFrame([(1, text, "x")], SCHEMA), plant=lambda w, _: w).collect()}
    assert got["abcdf"] == ("abcde", "abcde", 40) and got["abcgf"] == ("abcdf", "abcde", 20) and got["abhgf"] == ("abcgf", "abcde", 10)
    assert got["aihgf"] == (None, "aihgf", None) and got["abcde"] == (None, "abcde", None)


def test_edges(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, " 12 Ÿ "), (None, "Éclair éclair ÀÀÀÀÀ ×××××"), (4, "Éclair Éclair eclair × ×××××"), (4, "Éclair Éclair eclair × ×××××"), (5, "eclair eclairs eclairs eclairs eclairs"), (6, "q" * 3000), (6, "Q" * 3000), (7, "q" * 3000 + " " + "q" * 3001), (8, ("q" * 3001 + "-") * 7)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    want = plain(rows)
    assert set(map(tuple, variants.spelling_variants(frame).collect())) == want
    monkeypatch.setattr(variants, "SLICE", 5)
    assert "".join(variants.slices("abcdefg hij kl")) == "abcdefg hij kl" and list(variants.slices("abcdefg hij kl"))[0] == "abcdefg"
    assert variants.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert variants.spelling_variants(spark.createDataFrame([(1, "word word", "x")], SCHEMA)).collect() == []


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op11_variants(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, halves)
