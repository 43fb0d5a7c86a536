import numpy as np
from colloquy.llm import resemblance, simhash
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string"


def plain(texts, similarity=0.8, width=5):
    """For each text the index of the first one that similar texts lead to."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            either = len(sets[i] | sets[j])
            if not either or len(sets[i] & sets[j]) >= similarity * either:
                x, y = sorted((label[i], label[j]))
                label = [x if v == y else v for v in label]
    return label


def copies(seed):
    """Texts, and copies with some words changed, at similarities about 0.7 to 1."""
    rng = np.random.default_rng(seed)
    texts = []
    for k in range(12):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        texts.append(" ".join(words))
        for n in (1, 3, 5, 6, 8, 12):
            other = list(words)
            for place in rng.choice(300, n, replace=False):
                other[place] = f"new{k}"
            texts.append(" ".join(other))
    return texts


def test_against_all_pairs_in_cells_too(spark, monkeypatch):
    texts = copies(3) + [None, "", " ", "A b", "a B", "a b c d e f", "a b c d e g"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)
    for cell in (256, 2):
        monkeypatch.setattr(resemblance, "CELL", cell)
        assert sorted(r.doc_id for r in resemblance.keep_first(docs).collect()) == sorted(set(plain(texts)))


def test_stage_takes_copies_of_similarity_080(spark):
    import corpus_pipeline

    texts = copies(4)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == sorted(set(plain(texts)))
    rows = [(None, texts[0], "s"), (None, texts[7], "s"), (1, texts[14], "s"), (1, texts[21], "s")]
    assert corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").count() == 4
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").collect() == []


def test_tries_propose_what_bands_miss(spark):
    # Each text has a band of its own: whatever is linked, the tries have proposed.
    texts = copies(5) + ["a b c d e f g h", "h g f e d c b a"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)
    store = resemblance.Store(spark, "tried")
    rows = store.save(resemblance._classes(docs, 5).withColumn("bands", F.array(F.xxhash64("cls", F.lit("alone")))))
    edges = resemblance.links(docs, rows, store, 5, 0.8).collect()
    name = {r.cls: r.doc_id for r in rows.collect()}
    label = list(range(len(texts)))
    for a, b in ((name[e.a], name[e.b]) for e in edges):
        x, y = sorted((label[a], label[b]))
        label = [x if v == y else v for v in label]
    prints = [simhash.fingerprint(t, 5) for t in texts]
    sets = [resemblance.shingle_set(t, 5) for t in texts]
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= resemblance.BUDGET and resemblance._alike(sets[i], sets[j], 0.8):
                x, y = sorted((want[i], want[j]))
                want = [x if v == y else v for v in want]
    assert label == want and len(set(want)) < len(texts) - 12
