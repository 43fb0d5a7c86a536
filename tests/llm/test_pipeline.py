from collections import Counter

import corpus_pipeline
import pytest
from colloquy.llm import importance, mixing
from colloquy.llm.columns import row_hash
from pyspark.sql import functions as F
from test_packing import check as check_packing
from test_resemblance import plain as plain_groups
from test_suffix import plain as plain_removals


def test_stages_on_their_own_inputs(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs.collect(), spark.read.parquet(str(tmp_path / name))
        after = kept[name] = docs.collect()
        if k < 4:
            assert docs.columns == columns
        if name == "quality":
            flags = importance.resample(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in flags.collect() if r.kept)
            assert 0 < len(after) < len(before)
        elif name == "near_dedup":
            # The stage's contract: five-word shingles, similarity 0.8 (the four bits are the op9 query's).
            rows = sorted(before, key=lambda r: r.doc_id)
            assert sorted(r.doc_id for r in after) == sorted({rows[i].doc_id for i in plain_groups([r.text for r in rows])})
        elif name == "passage_dedup":
            want = plain_removals([r.text for r in before])
            size = {r.doc_id: len(r.text.encode()) for r in after}
            assert all(w[0] - w[1] - 3 * w[2] - 3 <= size[r.doc_id] <= w[0] - w[1] for r, w in zip(before, want))
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "mix":
            times = Counter(r.doc_id for r in after)
            assert max(times.values()) <= 3
            text = {r.doc_id: r.text for r in before}
            assert all(r.text == text[r.doc_id] for r in after)
        else:
            bins, bound = check_packing(after, [(r.doc_id, r.text) for r in before])
            assert bins <= bound + 1


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


#: Names that the operators use themselves.
CLASH = "id digest own row nth times bucket mass copies size source_size target taken _id _digest _size _n _nth _copy _places _whole places whole check key kind least root cls h bytes".split()


def odd_rows(spark, more=()):
    """Null ids and texts, repeated rows, one id with several texts, empty and long texts, under clashing column names."""
    long_text = " ".join(f"word{i % 977} of{i}" for i in range(30_000))
    texts = [(1, "plain text of some seven or eight words"), (1, "another text under the same id, with other words"), (None, "no id here but words all the same"), (None, "no id again and other words in it"),
             (None, None), (2, None), (3, ""), (4, " \n "), (5, "plain text of some seven or eight words"), (6, long_text), (7, "twice the same row in all columns"), (7, "twice the same row in all columns"), *more]
    rows = [(i, t, "en", ["a", "b", None][k % 3], len(t or "")) for k, (i, t) in enumerate(texts)]
    rows[11] = rows[10]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.col("n_chars").alias(c) for c in CLASH])


def lines(df):
    return Counter(map(str, df.collect()))


@pytest.fixture
def labelled(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 1, 0), (3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, labelled, name, stage):
    docs = odd_rows(spark)
    out = stage(spark, docs, labelled)
    got, before = lines(out), lines(docs)
    # Another order and other partitions of the rows change nothing.
    if name != "pack":
        assert out.columns == docs.columns
        assert lines(stage(spark, docs.orderBy(F.desc("n_chars")).repartition(5), labelled)) == got
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    kept = Counter((r.doc_id, r.text) for r in out.collect()) if name != "pack" else Counter()
    if name == "quality":
        assert all(before[k] == n for k, n in got.items())
        assert not [t for t in kept if not (t[1] or "").split()]
    elif name == "near_dedup":
        # Null and blank texts are alike; the same words under ids 1 and 5, and the repeated row, stay once.
        assert kept == Counter({t: 1 for t in texts if t not in ((None, None), (3, ""), (4, " \n "), (5, texts and "plain text of some seven or eight words"))})
        assert all(got[k] == 1 for k in got)
    elif name == "passage_dedup":
        assert got == before
    elif name == "mix":
        assert all(k in before and n <= 3 * before[k] for k, n in got.items())
        assert not [t for t in kept if not (t[1] or "").split()]
    else:
        check_packing(out.collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_empty_tables(spark, labelled, name, stage):
    docs = odd_rows(spark).filter("false")
    out = stage(spark, docs, labelled)
    assert out.collect() == [] and (name == "pack" or out.columns == docs.columns)


def test_passages_go_from_repeated_and_null_rows(spark):
    shared = " ".join(f"shared{i}" for i in range(60))
    docs = odd_rows(spark, [(8, "head " + shared), (None, shared + " tail"), (8, "x " + shared + " y")])
    got = {(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.passage_dedup(spark, docs, "").collect()}
    for r in docs.collect():
        want = r.text and r.text.replace(shared, "")
        near = [t for i, t, n in got if i == r.doc_id and (t == want or want and shared in r.text and abs(len(t or "") - len(want)) <= 2)]
        assert near, (r.doc_id, r.text)


def test_mixes_take_the_planned_rows(spark):
    # Rows of one id and size that differ only in their text keep their own copies.
    rows = [(1, f"a b{i}", "s", i) for i in range(40)] + [(2, "w " * 200, "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    plan = mixing.mix(docs)
    want = Counter()
    for r in docs.withColumn("h", row_hash(docs)).join(plan.select("own", F.col("copies").alias("times")), F.col("h") == F.col("own")).collect():
        want[r.text] += r.times
    for order in (docs, docs.orderBy(F.desc("text")).repartition(3)):
        assert Counter(r.text for r in mixing.apply_mix(order, plan).collect()) == +want
