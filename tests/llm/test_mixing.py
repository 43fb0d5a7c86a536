import re
from collections import defaultdict

import numpy as np
from colloquy.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


def water_level(sizes, weights, cap):
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if level * weights[i] > cap * sizes[i]]
        if not over:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in over:
            target[i] = float(cap * sizes[i])
            left -= target[i]
            open_.remove(i)
    return target


def check(rows, docs):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += words(text)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    want = dict(zip(order, water_level([sizes[s] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))], 3)))
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in order:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_duels_keep_the_words_and_the_expectation():
    sizes = np.array([5.0, 7.0, 3.0, 9.0, 1.0, 4.0])
    start = sizes * np.array([0.3, 0.5, 0.9, 0.2, 0.7, 0.4])
    hits = np.zeros(6)
    for k in range(4000):
        mass, rng = start.copy(), np.random.default_rng(k)
        taken, left = mixing.duel_all(sizes, mass, rng.random(6))
        assert abs(mass.sum() - start.sum()) < 1e-9
        if left >= 0:
            taken[left] = rng.random() * sizes[left] < mass[left]
        hits += taken
    assert np.abs(hits / 4000 - start / sizes).max() < 0.04


def test_edges_and_reruns(spark):
    docs = [(i, "a b c " * (i % 7), "s%d" % (i % 4)) for i in range(900)] + [(1, None, None), (2, "", "é"), (3, "x y", None), (3, "x y", None), (None, "q", "s1")]
    rows = [(i, t, None, s, 0, "clash") for i, t, s in docs]
    a = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    check(a, docs)
    b = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_apply(spark):
    docs = spark.createDataFrame([(i, "w " * i, None, "a", 0, "z") for i in range(30)] + [(4, "w w", None, "b", 0, "z")], SCHEMA)
    plan = mixing.mix(docs)
    got = mixing.apply_mix(docs, plan)
    assert got.columns == docs.columns
    assert got.count() == sum(r.copies for r in plan.collect())


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(mixing.mix(docs).collect(), [(r.doc_id, r.text, r.source) for r in docs.collect()])
