import math

import numpy as np
from colloquy.llm import importance, queries
from colloquy.llm.store import Store
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, kept string, kind int"


def test_kth_largest(spark):
    rng = np.random.default_rng(0)
    values = [float(v) for v in np.concatenate((rng.normal(size=3000), [1.25] * 500, [-1e9, 1e9]))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 300, 900, 3502):
        assert importance.kth_largest(df, "v", k, few=50) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(df, "v", 0) is None


def test_counts_cover_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = importance._label_kinds(spark.read.parquet(f"{sf}/labels.parquet"), 60)
    kinds = {r.doc_id: r.kind for r in labels.collect()}
    want = np.zeros((6, importance.SIZE), np.int64)
    for d in docs.collect():
        f = np.bincount(importance.features(d.text), minlength=importance.SIZE)
        want[0] += f
        if d.doc_id in kinds:
            want[kinds[d.doc_id]] += f
            if kinds[d.doc_id] != 2:
                want[4 + (kinds[d.doc_id] == 3)] += f > 0
    got = np.zeros_like(want)
    for r in importance._counts(docs, labels).collect():
        got[:, r.place] = tuple(r)[1:]
    assert len(kinds) == 60 and np.array_equal(got, want)


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    used = {r.doc_id for r in importance._label_kinds(labels, 2000).collect()}
    kept = {r.doc_id: r.kept for r in importance.resample(docs, labels, max_labels=2000).collect()}
    rates = {}
    for r in labels.collect():
        if r.doc_id not in used:
            rates.setdefault((r.quality, r.toxic), []).append(kept[r.doc_id])
    mean = {k: sum(v) / len(v) for k, v in rates.items()}
    print(mean)
    assert mean[1, 0] > 0.97 and mean[0, 0] < 0.05 and mean[1, 1] < 0.1


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x", 0), (2, "", "x", 0), (None, "good words here", "x", 0), (3, "bad " * 9000, None, 0), (4, "good words", "x", 0), (4, "good words", "x", 0)], SCHEMA)
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (3, 0, 0), (3, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = importance.resample(docs, labels).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == 6 and not kept[1] and not kept[2] and not kept[3] and kept[4]
    none = importance.resample(docs, labels.filter("false")).collect()
    assert {r.doc_id: r.kept for r in none} == {1: False, 2: False, None: True, 3: True, 4: True}
    assert importance.resample(docs.filter("false"), labels).collect() == []


def test_weights_rank_by_the_ratio():
    counts = np.zeros((6, importance.SIZE), np.int64)
    good, bad = importance.features("fine prose of many words"), importance.features("spam spam spam")
    np.add.at(counts[0], np.concatenate((good, bad)), 1000)
    np.add.at(counts[1], good, 500)
    np.add.at(counts[2], bad, 500)
    model = importance.Model(counts, (10, 10, 0))
    assert model.weight(good) > 0 > model.weight(bad) and math.isfinite(model.weight(bad))


def test_best_level():
    w = np.array([-9.0, -3.0, -3.0, -1.0, 2.0, 5.0])
    assert importance.best_level(w, w > -2) == -3.0
    assert importance.best_level(w, w > -20) == importance.LEVEL
    assert importance.best_level(w, np.array([False, False, True, True, True, True])) in (-9.0, -3.0)
    assert importance.best_level(w, np.array([True, False, False, False, False, False])) in (-9.0 - 1, -9.0)


def plain_weights(texts, kinds):
    """Log weights by definition: rates of each kind of n-gram, one document and one place at a time."""
    counts = np.zeros((4, importance.SIZE))
    held = np.zeros((2, importance.SIZE))
    for t, kind in zip(texts, kinds):
        for place in importance.features(t):
            counts[0, place] += 1
            if kind:
                counts[kind, place] += 1
        if kind in (1, 3):
            held[int(kind == 3), np.unique(importance.features(t))] += 1
    n = [sum(k == x for k in kinds) for x in (1, 2, 3)]
    target, junk, sign = (np.zeros(importance.SIZE) for _ in range(3))
    for lo, hi in zip(importance.STARTS, importance.STARTS[1:]):
        total = counts[:, lo:hi].sum(axis=1)
        for p in range(lo, hi):
            base = (counts[0, p] + 0.5) / (total[0] + 0.5 * (hi - lo))
            ratio = lambda k: math.log((counts[k, p] + importance.PRIOR * base) / (total[k] + importance.PRIOR) / base)  # noqa: E731, B023
            if lo != importance.UNI:
                rare = base * total[1] < importance.COMMON
                target[p] = max(-importance.CLIP, min(importance.CLIP, ratio(1))) if rare else ratio(1)
                junk[p] = ratio(2)
            if lo <= importance.UNI:
                share = (held[0, p] + 0.5) / (n[0] + 1)
                times = (held[1, p] + 0.5) / (n[2] + 1) / share
                if held[1, p] - share * n[2] > importance.Z_TOXIC * math.sqrt(share * n[2] + 0.5) and times > importance.TIMES_TOXIC and held[1, p] >= importance.SHARE_TOXIC * n[2]:
                    sign[p] = math.log(times)
    odds = [math.log(max(1e-6, x / max(1, sum(n)))) - m for x, m in zip(n[1:], importance.MARGINS)]
    out = []
    for t in texts:
        f = importance.features(t)
        words = len((t or "").encode().translate(importance._LOWER).split())
        toxic = {(a, b): sign[a] + sign[b] for a, b in zip(f[:words], f[words : 2 * words]) if sign[a] and sign[b]}
        good, bad = target[f].sum(), junk[f].sum()
        logs = [0.0, bad + odds[0], good + sum(toxic.values()) + odds[1]]
        out.append(good - max(logs) - math.log(sum(math.exp(x - max(logs)) for x in logs)))
    return out


def test_whole_query_against_brute_force(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    kinds = importance._label_kinds(labels, importance.MAX_LABELS)
    rows = docs.join(kinds, "doc_id", "left").withColumn("tuning", importance._tuning(kinds)).withColumn("u", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 52))).collect()
    weights = plain_weights([r.text for r in rows], [0 if r.kind is None or r.tuning else r.kind for r in rows])
    size = [len(importance.features(r.text)) for r in rows]
    tuned = [(w, r.kind == 1) for w, r, n in zip(weights, rows, size) if r.kind and r.tuning and n]
    # The level by trying every weight.
    tries = sorted({w for w, _ in tuned} | {min(w for w, _ in tuned) - 1})
    good, bad = [w for w, g in tuned if g], [w for w, g in tuned if not g]
    if good and bad:
        level = max(tries, key=lambda t: (round(sum(w > t for w in good) / len(good) + sum(w <= t for w in bad) / len(bad), 12), -t))
    else:
        level = importance.LEVEL
    k = sum(n > 0 and w > level for w, n in zip(weights, size))
    keys = [w - math.log(-math.log((r.u + 0.5) / (1 << 52))) if n else -math.inf for w, r, n in zip(weights, rows, size)]
    cut = sorted(keys, reverse=True)[k - 1] if k else math.inf
    want = {r.doc_id: (n, key >= cut and n > 0) for r, n, key in zip(rows, size, keys)}
    got = queries.op8_importance(spark, sf).collect()
    assert len(got) == len(rows) and {r.doc_id: (r.n_features, r.kept) for r in got} == want
    by = {r.doc_id: w for r, w in zip(rows, weights)}
    assert max(abs(r.log_weight - by[r.doc_id]) for r in got) < 1e-6
