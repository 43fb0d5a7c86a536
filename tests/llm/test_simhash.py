import numpy as np
import xxhash
from colloquy.llm import queries, simhash

SCHEMA = "doc_id long, text string, fp string, source string"


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, budget):
    """fps: list of (id, fp)."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= budget:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(fps))]


def test_fingerprint():
    for text in ["", None, " \t\n", "One", "a b c", "a b c d", "A B c d e f", "é É ü x y z w v", "be " * 500]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    long = " ".join(f"w{i * i % 97}" for i in range(20000))
    assert simhash.fingerprint(long) == plain_fingerprint(long)


def test_native_hash_is_the_contracts(spark):
    word = spark.range(1).selectExpr("xxhash64('a b c d') AS h").first()[0]
    assert word % 2**64 == xxhash.xxh64(b"a b c d", seed=42).intdigest()


def links(spark, fps, budget, cell):
    from colloquy.llm.components import components
    from colloquy.llm.store import Store

    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in set(fps)], "fp long")
    labels = components(simhash.trie_links(df, budget, cell), Store(spark, "t")).collect()
    root = {r.node: r.root for r in labels}
    return {f: root.get(int(np.uint64(f).view(np.int64)), int(np.uint64(f).view(np.int64))) for f in fps}


def test_trie_join_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = {0, 2**64 - 1}
    for b in base.tolist():
        fps.add(b)
        for _ in range(12):
            f = b
            for bit in rng.choice(64, rng.integers(1, 9), replace=False).tolist():
                f ^= 1 << bit
            fps.add(f)
    fps = sorted(fps)
    want = plain_components(list(enumerate(fps)), 4)
    for cell in (2048, 8):
        got = links(spark, fps, 4, cell)
        for i in range(len(fps)):
            for j in range(i):
                assert (got[fps[i]] == got[fps[j]]) == (want[i] == want[j])


def test_more_blocks_when_there_are_more_fingerprints():
    assert len(simhash.block_plan(10_000, 4)) == 5
    plan = simhash.block_plan(10**10, 4)
    assert len(plan) == 35 and all(len(p) == 3 for p in plan)
    for p in plan + simhash.block_plan(1, 4):
        assert sum(w for _, w in p) <= 63


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op9_simhash(spark, sf).collect()}
    fps = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    for (i, f), c in zip(fps, plain_components(fps, 4)):
        assert (got[i].fingerprint, got[i].component_id) == (f"{f:016x}", c)


def test_edges(spark):
    rows = [(5, None, "x", "s"), (3, "", "x", "s"), (9, "a b", "x", "s"), (9, "a b", "x", "s"), (None, "A b", "x", None), (7, " ", "x", "s"), (11, "z " * 3000, "x", "s")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == [(-1, 9), (3, 3), (5, 3), (7, 3), (9, 9), (9, 9), (11, 11)]
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_first_keeps_one_of_each_component(spark):
    words = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [(None, words[0], "x", "s"), (None, words[1], "x", "s"), (1, words[2], "x", "s"), (1, words[3], "x", "s"), (7, words[2], "y", "s"), (7, words[3], "y", "s"), (None, words[3], "z", "s"), (1, words[2], "x", "s")]
    kept = simhash.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.text for r in kept) == words
    assert {r.text: r.doc_id for r in kept} == {words[0]: None, words[1]: None, words[2]: 1, words[3]: 1}


def test_hot_subtries_go_down_further_levels(spark):
    # Fingerprints that agree in their upper half fill a few leads; a small cell sends them down and into cells.
    rng = np.random.default_rng(6)
    low = rng.integers(0, 1 << 32, 500, dtype=np.uint64)
    fps = np.unique(np.concatenate((low, low[:200] ^ (np.uint64(1) << rng.integers(0, 32, 200).astype(np.uint64)), rng.integers(0, 1 << 63, 300, dtype=np.uint64))))
    classes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    names = [int(x) for x in fps.view(np.int64)]
    want = plain_groups(fps, 4)
    for cell in (8, 2048):
        label = {x: x for x in names}

        def root(x):
            while label[x] != x:
                x = label[x]
            return x

        for r in simhash.trie_links(classes, 4, cell).collect():
            assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 64
            a, b = sorted((root(r.a), root(r.b)))
            label[b] = a
        groups = {}
        for x in names:
            groups.setdefault(root(x), set()).add(x)
        assert {frozenset(g) for g in groups.values()} == want


def plain_groups(fps, budget):
    """Sets of fingerprints, as signed numbers, that links within budget join."""
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= budget
    while True:
        least = np.array([label[row].min() for row in near])
        if np.array_equal(least, label):
            break
        label = least
    signed = fps.view(np.int64)
    return {frozenset(int(x) for x in signed[label == k]) for k in set(label.tolist())}
