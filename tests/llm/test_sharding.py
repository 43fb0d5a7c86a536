import duckdb
import hashlib
from colloquy.llm import sharding

SCHEMA = "doc_id long, text string, shard string, bytes string"


def h(key):
    return int(hashlib.md5(("null" if key is None else str(key)).encode()).hexdigest()[:15], 16)


def test_against_sql_with_small_limits(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    for limit in (4_000, 60_000, 1 << 30):
        got = sorted(map(tuple, sharding.shard(docs, limit).collect()))
        assert got == sorted(con.execute(sharding.oracle(limit)).fetchall())
        assert all(r[5] <= limit or r[6] == 1 for r in got)


def test_skew_and_deep_buckets(spark):
    # One huge document makes its bucket split until it is alone.
    rows = [(i, "x" * 10, "s", "b") for i in range(300)] + [(999, "y" * 5000, "s", "b")]
    got = sharding.shard(spark.createDataFrame(rows, SCHEMA), 100).collect()
    total = {}
    for r in got:
        assert format(h(r.doc_id), "060b").startswith(r.shard) and len(r.shard) == r.depth
        total.setdefault((r.shard, r.part), []).append(r.bytes)
    for r in got:
        own = total[r.shard, r.part]
        assert (sum(own), len(own)) == (r.shard_bytes, r.shard_docs) and (sum(own) <= 100 or len(own) == 1)
    # Only oversized buckets split: the bucket of the bits above each shard doesn't fit.
    for r in got:
        if r.depth:
            assert sum(x.bytes for x in got if format(h(x.doc_id), "060b").startswith(r.shard[:-1])) > 100


def test_repeated_keys_are_cut_into_parts(spark):
    rows = [(7, "z" * 30, None, "b")] * 40 + [(7, "z" * 90, "s", "b")] * 2 + [(None, None, "s", "b"), (8, "", "s", "b")]
    got = sharding.shard(spark.createDataFrame(rows, SCHEMA), 100).collect()
    assert len(got) == len(rows)
    total = {}
    for r in got:
        total.setdefault((r.shard, r.part), []).append(r.bytes)
    assert all(sum(v) <= 100 for v in total.values())
    assert all(r.shard_bytes == sum(total[r.shard, r.part]) for r in got)
    assert sharding.shard(spark.createDataFrame([], SCHEMA), 100).collect() == []


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * i) for i in range(50)], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "out"), 200)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_no_python_in_the_plan(spark, sf):
    plan = sharding.shard(spark.read.parquet(f"{sf}/documents.parquet"), 10_000)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_written_shards_hold_null_and_repeated_ids_once(spark, tmp_path):
    rows = [(7, "z" * 30)] * 20 + [(7, "y" * 30), (7, "z" * 90), (None, "n" * 40), (None, "m" * 40), (None, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "out"), 100)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    total = {}
    for r in got:
        total[r.shard, r.part] = total.get((r.shard, r.part), 0) + len(r.text or "")
    assert max(total.values()) <= 100


def test_hot_keys_and_clashing_names(spark, tmp_path):
    # A third of all rows under one null id, some of them empty, over many partitions.
    rows = [(None, "x" * (i % 7), "s", "b") for i in range(3000)] + [(i, "y" * 5, "s", "b") for i in range(6000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(13)
    got = sharding.shard(docs, 500).collect()
    total = {}
    for r in got:
        total.setdefault((r.shard, r.part), []).append(r.bytes)
    assert len(got) == 9000 and all(sum(v) <= 500 for v in total.values())
    assert all((r.shard_bytes, r.shard_docs) == (sum(total[r.shard, r.part]), len(total[r.shard, r.part])) for r in got)
    sharding.write_shards(docs.limit(200), str(tmp_path / "out"), 500)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and set(back.columns) == {"doc_id", "text", "shard", "bytes", "_shard", "part"}
