import random

import numpy as np
import pytest
from colloquy.functions.text import contains_literal
from colloquy.operators import index, inverted, literal, search, speakers
from colloquy.sources import versions
from pyspark.sql import functions as F


def chunks(spark, *rows):
    return spark.createDataFrame([(f"{s}_{i}", s, i, v) for s, i, v in rows], "id string, source string, i long, v string")


def place():
    return F.pmod(F.xxhash64("source"), F.lit(4))


def held(table, version=None):
    return sorted((r.id, r.v) for r in table.read(version=version).collect())


def test_upserts_rewrite_what_they_touch(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    versions.upsert(table, chunks(spark, *[(s, i, "old") for s in "abcdefgh" for i in range(3)]), place(), scope="source")
    first = table.manifest()
    assert sum(e["rows"] for e in first.buckets.values()) == 24
    # a gets shorter, z is new, and of two rows with one key the later one stays.
    versions.upsert(table, chunks(spark, ("a", 0, "new"), ("a", 0, "newer"), ("z", 0, "new")), place(), scope="source", order=["v"])
    second = table.manifest()
    want = sorted([(f"{s}_{i}", "old") for s in "bcdefgh" for i in range(3)] + [("a_0", "newer"), ("z_0", "new")])
    assert held(table) == want and len(held(table, version=1)) == 24
    touched = {r[0] for r in spark.createDataFrame([("a",), ("z",)], "source string").select(place()).collect()}
    assert {b for b in second.buckets if second.buckets[b] != first.buckets.get(b)} == touched
    assert sorted(map(tuple, table.tombstones().collect())) == [("a_1", 2), ("a_2", 2)] and table.tombstones(since=2).count() == 0
    versions.remove(table, spark.createDataFrame([("b",)], "source string"), place())
    assert held(table) == [r for r in want if r[0][0] != "b"] and table.tombstones(since=2).count() == 3
    assert table.vacuum() > 0 and held(table) == [r for r in want if r[0][0] != "b"]
    versions.upsert(table, chunks(spark), place(), scope="source")
    assert held(table) == [r for r in want if r[0][0] != "b"]


def test_a_crash_between_steps_changes_nothing(spark, tmp_path, monkeypatch):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    versions.upsert(table, chunks(spark, ("a", 0, "old"), ("b", 0, "old")), place(), scope="source")
    before = held(table)
    new = chunks(spark, ("a", 0, "new"))
    for step in ("_publish", "_hadoop"):
        with monkeypatch.context() as m:

            def crash(*a, **k):
                raise OSError("gone")

            if step == "_hadoop":  # after the draft, before it takes its place
                real = table._hadoop
                m.setattr(table, "_hadoop", lambda *parts: crash() if parts[-1].startswith("0") and parts[0] == "manifest" and draft() else real(*parts))
                draft = lambda: any(p.name.endswith(".draft") for p in (tmp_path / "t" / "manifest").iterdir())
            else:
                m.setattr(table, step, crash)
            with pytest.raises(OSError):
                versions.upsert(table, new, place(), scope="source")
        assert table.version() == 1 and held(table) == before
    versions.upsert(table, new, place(), scope="source")
    assert held(table) == [("a_0", "new"), ("b_0", "old")]


def test_of_two_writers_the_later_one_fails(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    versions.upsert(table, chunks(spark, ("a", 0, "old")), place(), scope="source")
    base, rows = table.manifest(), table.read()
    table.replace(rows.withColumn("v", F.lit("one")), list(base.buckets), base)
    with pytest.raises(versions.ChangedMeanwhile):
        table.replace(rows.withColumn("v", F.lit("two")), list(base.buckets), base)
    assert held(table) == [("a_0", "one")] and not [p for p in (tmp_path / "t" / "manifest").iterdir() if p.name.endswith(".draft")]


def vectors(spark, n, groups, width=16, seed=1, spread=0.35):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((groups, width))
    m = centre[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, width))
    rows = [(i, m[i].tolist(), "summary" if i % 10 == 0 else "raw_transcript", f"s{i % 7}") for i in range(n)]
    return m, spark.createDataFrame(rows, "id long, embedding array<double>, category string, source string").repartition(4)


def test_inverted_file(spark, tmp_path):
    m, rows = vectors(spark, 3000, 40)
    odd = spark.createDataFrame([(9000, None, "summary", "o"), (9001, [], "summary", "o"), (9002, [0.0] * 16, "summary", "o"), (9003, m[5].tolist(), "raw_transcript", "o")], rows.schema)
    rows = rows.unionByName(odd)
    file = inverted.InvertedFile(spark, str(tmp_path / "f"))
    file.build(rows, cells=40)
    assert file.table.read().count() == 3004 and len(file.table.manifest().buckets) > 20
    usable = rows.filter("size(embedding) > 0")
    for at in (0, 5, 1234):
        for category in (None, "raw_transcript"):
            want = [(r.id, round(r.similarity, 9)) for r in search.retrieve(usable, m[at].tolist(), 12, category).collect()]
            exact = file.search(m[at].tolist(), 12, nprobe=2, category=category, exact=True)
            assert [(r.id, round(r.similarity, 9)) for r in exact.collect()] == want
            assert len(exact.inputFiles()) < len(file.table.read().inputFiles()) / 2
            few = file.search(m[at].tolist(), 12, nprobe=2, category=category)
            assert len(few.inputFiles()) < len(file.table.read().inputFiles()) / 4
    queries = rows.filter("id % 50 = 0 AND id < 9000").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    every = file.search_many(queries, 10, nprobe=None)
    got = sorted((r.query_id, r.id) for r in every.collect())
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    with_copy, ids = np.vstack([unit, unit[5]]), np.append(np.arange(3000), 9003)
    want = []
    for q in range(0, 3000, 50):
        sims = np.round(with_copy @ unit[q], 12)
        want += [(q, int(ids[i])) for i in sorted(range(3001), key=lambda i: (-sims[i], ids[i]))[:10]]
    assert got == sorted(want)
    assert inverted.recall(file.search_many(queries, 10, nprobe=6), every) >= 0.95
    assert inverted.recall(file.search_many(queries, 10, nprobe=1), every) < 1


def test_inverted_file_of_tasks_without_rows(spark, tmp_path):
    m, rows = vectors(spark, 300, 6)
    small = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        file = inverted.InvertedFile(spark, str(tmp_path / "f"))
        file.build(rows.repartition(40), cells=6)
        want = [r.id for r in search.retrieve(rows, m[7].tolist(), 9).collect()]
        assert [r.id for r in file.search(m[7].tolist(), 9, nprobe=1, exact=True).collect()] == want
        asked = rows.filter("id = 7").select(F.col("id").cast("string").alias("query_id"), F.col("embedding").alias("vector"))
        assert sorted(r.id for r in file.search_many(asked, 9, nprobe=2).collect())[0] >= 0
        assert sorted(r.id for r in file.search_many(asked, 9, nprobe=None).collect()) == sorted(want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_inverted_file_takes_rows_in_and_out(spark, tmp_path):
    m, rows = vectors(spark, 600, 12)
    file = inverted.InvertedFile(spark, str(tmp_path / "f"))
    file.build(rows, cells=12)
    before = file.table.manifest().buckets
    moved = rows.filter("id IN (1, 2)").withColumn("embedding", F.transform("embedding", lambda x: -x))
    file.add(moved, spark.createDataFrame([("3",)], "key string"))
    after = file.table.manifest().buckets
    assert sum(e["rows"] for e in after.values()) == 599 and len([b for b in before if after.get(b) == before[b]]) >= len(before) - 7
    now = rows.filter("id NOT IN (1, 2, 3)").unionByName(moved)
    for at in (1, 3, 77):
        want = [r.id for r in search.retrieve(now, m[at].tolist(), 9).collect()]
        assert [r.id for r in file.search(m[at].tolist(), 9, nprobe=1, exact=True).collect()] == want
    empty = inverted.InvertedFile(spark, str(tmp_path / "e"))
    empty.build(rows.limit(0))
    assert empty.search(m[0].tolist(), 3).collect() == []


def rows_read(frame):
    """A frame's rows, and how many its scans read behind row groups that were left out."""
    rows = frame.collect()

    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(node.plan())
        own = node.metrics().get("numOutputRows").get().value() if name == "FileSourceScanExec" else 0
        children = node.children()
        return own + sum(scans(children.apply(i)) for i in range(children.size()))

    return rows, scans(frame._jdf.queryExecution().executedPlan())


def test_literal_index(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(literal, "PART", 16)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    texts = [(f"d{i}", "raw_transcript", " ".join(rng.choice(words) for _ in range(rng.randrange(0, 120)))) for i in range(900)]
    texts += [("null", "summary", None), ("empty", "summary", ""), ("short", "summary", "ab"), ("caps", "summary", "The ÉTÉ needle"), ("caps", "summary", "The ÉTÉ needle"), ("emoji", "summary", "x😀y needles"), ("aaa", "summary", "aaaaaaaaaa")]
    files = spark.createDataFrame(texts, "source string, category string, document string").repartition(5)
    index = literal.LiteralIndex(spark, str(tmp_path / "i")).build(files)
    queries = ["needle", "NEEDLE", "été", "😀y", "aaaa", "aaaaaaaaaaa", "ab", "b", words[0], words[1] + " " + words[2], texts[17][2][5:30], "nowhere at all", "e needles", "x😀y needles"]
    for q in queries:
        want = sorted(tuple(r) for r in files.filter(contains_literal(F.col("document"), q)).collect())
        assert sorted(tuple(r) for r in index.search(q).collect()) == want, q
    asked = spark.createDataFrame([*enumerate(queries), (99, ""), (98, None), (97, "needle")], "query_id long, literal string")
    want = sorted((i, s) for i, q in [*enumerate(queries), (97, "needle")] for s, _, t in texts if t is not None and q.lower() in t.lower())
    assert sorted(map(tuple, index.search_many(asked).collect())) == want


def test_literals_in_parts_of_short_texts_only(spark, tmp_path):
    rows = [("a", "summary", "ab"), ("b", "summary", ""), ("c", "summary", None), ("d", "summary", "x" * 70_000 + "needle"), ("e", "summary", "lene"), ("f", "summary", "edle")]
    for part in (rows[:3], rows):
        files = spark.createDataFrame(part, "source string, category string, document string").coalesce(1)
        held = literal.LiteralIndex(spark, str(tmp_path / str(len(part)))).build(files)
        want = ["d"] if len(part) > 3 else []
        assert [r.source for r in held.search("needle").collect()] == want
        asked = spark.createDataFrame([(1, "needle"), (2, "leneed")], "query_id long, literal string")
        assert [tuple(r) for r in held.search_many(asked).collect()] == [(1, s) for s in want]


def test_rare_literals_read_little(spark, tmp_path):
    rng = random.Random(3)
    line = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(4000))
    texts = [(f"d{i}", "raw_transcript", line() + (" $$needle$$ " if i == 777 else "")) for i in range(1500)]
    files = spark.createDataFrame(texts, "source string, category string, document string").repartition(3)
    index = literal.LiteralIndex(spark, str(tmp_path / "i")).build(files)
    got, read = rows_read(index.search("$$needle$$"))
    scan, whole = rows_read(index.texts().filter(contains_literal(F.col("document"), "$$needle$$")))
    assert [r.source for r in got] == [r.source for r in scan] == ["d777"] and whole == 1500 and read < 600
    gram = index.rarest("$$needle$$")[0][0]
    found, read = rows_read(index.postings().filter(F.col("gram") == gram))
    assert len(found) == 1 and read < index.postings().count() / 4


def by_pattern(chunks, variants, key):
    """Each variant looked for as a whole word in each text, by a pattern."""
    pattern = F.concat(F.lit(r"(?U)\b\Q"), F.lower("variant"), F.lit(r"\E\b"))
    met = chunks.crossJoin(variants).filter(F.lower("variant").rlike(r"(?U)\w") & F.call_function("rlike", F.lower("text"), pattern))
    return {tuple(r) for r in met.select(*key, "person", "variant").collect()}


def test_names_by_windows(spark, monkeypatch):
    rng = random.Random(4)
    pieces = ["ann", "Lee", "élan", "o", "x_1", "é", " ", " ", ". ", "-", "'", "(", ") ", "9"]
    rows = [(i, None if i == 5 else "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 25)))) for i in range(120)]
    said = {"".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6))) for _ in range(300)} | {"ann", "Lee", "(ann", "ann)", "ann lee", "", " ", "--", "o'x_1"}
    texts = spark.createDataFrame(rows, "k long, text string")
    variants = spark.createDataFrame([(f"p{i % 40}", v) for i, v in enumerate(sorted(said))], speakers.VARIANTS)
    want = by_pattern(texts.filter("text IS NOT NULL"), variants, ["k"])
    assert len(want) > 200 and {tuple(r) for r in speakers.scan_names(texts, variants, ["k"]).collect()} == want
    monkeypatch.setattr(speakers, "SENT", 0)
    assert {tuple(r) for r in speakers.scan_names(texts, variants, ["k"]).collect()} == want
    assert speakers.scan_names(texts, variants.limit(0), ["k"]).collect() == []


def test_hundred_thousand_names_meet_texts_once(spark, sf):
    from colloquy.plans import catalog

    plan = catalog.QUERIES["names_of_documents"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conversations.parquet") <= 1 and plan.count("MapInPandas") == 1
    assert catalog.QUERIES["names_of_documents"](spark, "/root/testdata/sf0.01").count() > 1000


def test_words_in_a_row_and_the_text_apart(spark):
    rows = [(1, "de, la; pide lado"), (2, "de, la"), (3, "pide lado"), (4, "de la"), (5, "a de - la b. x de la"), (6, " ... ")]
    texts = spark.createDataFrame(rows, "k long, text string")
    variants = spark.createDataFrame([("leon", "De La"), ("leon", "o'x")], speakers.VARIANTS)
    found = lambda **how: sorted(r.k for r in speakers.scan_names(texts, variants, ["k"], **how).collect())
    assert found(apart=True) == [1, 4, 5] and found() == [4, 5]


def test_names_in_one_pass_as_by_joins(spark, sf, monkeypatch):
    """One column finds what the join finds, in both ways of looking, and nothing is shuffled for it."""
    said = ["Ann Lee spoke", "ann  lee", "de, la pide lado", "De La", "O'X, o'x", "x o'x", "é ann", "annlee", "", None, "(b) ann.", "b) c", " b) c", "la. de la"]
    rows = [(f"s{k}", k, t if t is None else t + " 1 2 3 4 5 6 7 8 9 10") for k, t in enumerate(said)] + [("short", 0, "ann 2 3 4 5 6 7 8 9 10"), ("ten", 1, "ann\u00a02 3 4 5 6 7 8 9 10 11")]
    chunks = spark.createDataFrame(rows, "source string, chunk_index int, chunk string")
    variants = spark.createDataFrame([("p", "ann"), ("q", "Ann Lee"), ("é", "é"), ("leon", "De La"), ("x", "o'x"), ("y", ") c"), ("a", "ann"), ("none", "--"), (None, "b")], speakers.VARIANTS)
    for apart in (False, True):
        one = index.with_names(chunks, "persons", variants, apart)
        assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, one.select("source", "chunk_index", "persons").collect()))
        with monkeypatch.context() as m:
            m.setattr(speakers, "GAZETTEER", 3)
            joined = index.with_names(chunks, "persons", variants, apart)
            assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
            assert got == sorted(map(tuple, joined.select("source", "chunk_index", "persons").collect()))
        assert dict((r[0], r[2]) for r in got)["ten"] == "a, p" and dict((r[0], r[2]) for r in got)["short"] is None
    assert index.with_names(chunks, "persons", variants.limit(0)).filter("persons IS NOT NULL").collect() == []
