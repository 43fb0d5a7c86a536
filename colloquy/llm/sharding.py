"""Sharding by extendible hashing, in DataFrame operations only.

A directory maps prefixes of a 60-bit key hash to shards. It starts with about
eight entries for each shard that the bytes call for; a bucket above the limit
takes another bit, and only such buckets do. A round settles every prefix that
fits within the bits it looks at; the buckets that are still too large go on to
a round with more bits, so all other rows are left alone.

Edge cases: a null text has 0 bytes; null keys hash alike; rows that share a
key cannot be told apart by any bit, so a key whose rows exceed the limit is
cut into numbered parts instead; one document above the limit is a shard of its
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import byte_count, held
from .store import Store

BITS = 60
#: Bits added to the directory in each further round.
STEP = 6


def key_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key as text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def _directory(rows: DataFrame, base: int, bits: int, limit: int) -> DataFrame:
    """For each prefix of `bits` bits in rows: the shard that it belongs to, or null where it has to grow.

    The rows' buckets of `base` bits are known to be too large (none is known for base -1).
    """
    fine = rows.groupBy(_prefix(F.col("h"), bits).alias("prefix")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"), F.min("h").alias("low"), F.max("h").alias("high")
    )
    above = fine.withColumn("depth", F.explode(F.sequence(F.lit(base + 1), F.lit(bits))))
    above = above.withColumn("node", F.call_function("shiftright", F.col("prefix"), F.lit(bits) - F.col("depth")))
    nodes = above.groupBy("depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"), F.min("low").alias("low"), F.max("high").alias("high"))
    fits = nodes.filter((F.col("shard_bytes") <= limit) | (F.col("low") == F.col("high")))
    shard = F.min(F.struct("depth", "node", "shard_bytes", "shard_docs"))
    placed = above.select("prefix", "depth", "node").join(fits, ["depth", "node"]).groupBy("prefix").agg(shard.alias("shard"))
    return fine.select("prefix").join(placed, "prefix", "left")


def _parts(rows: DataFrame, limit: int, store: Store) -> DataFrame:
    """Numbers the parts of keys whose rows exceed the limit; every other row is part 0.

    Such a key may have very many rows. They are sorted over all tasks by a
    range partitioning, each task adds up its own, and a key's few totals, one
    for each task, are added before them.
    """
    many = (F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1)
    whole = rows.filter(~many).withColumn("part", F.lit(0).cast("long"))
    if rows.filter(many).isEmpty():
        return whole
    half, key = limit // 2, ["h", "large"]
    cut = store.save(rows.filter(many).withColumn("large", F.col("bytes") > half).withColumn("salt", F.monotonically_increasing_id()))
    order = [*key, "bytes", "salt"]
    ranged = store.save(cut.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("task", F.shiftright("at", 33))
    own = Window.partitionBy("task", *key).orderBy("at")
    ranged = ranged.withColumn("before", F.coalesce(F.sum("bytes").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("nth", F.row_number().over(own))
    totals = ranged.groupBy("task", *key).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*key).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("task", *key, F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    placed = ranged.join(offsets, ["task", *key])
    part = F.when(F.col("large"), -(F.col("n0") + F.col("nth"))).otherwise(F.floor((F.col("b0") + F.col("before")) / F.lit(float(max(1, half)))))
    placed = store.save(placed.withColumn("part", part.cast("long")).select(*rows.columns, "part"))
    # A part of empty documents may have very many rows: totals are joined, not windowed.
    sums = store.save(placed.groupBy("h", "part").agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")))
    summed = placed.join(sums, ["h", "part"]).withColumn("shard_bytes", F.col("b")).withColumn("shard_docs", F.col("n"))
    return whole.unionByName(summed.select(*whole.columns))


def _placed(docs: DataFrame, limit: int, key: str, carry: bool) -> DataFrame:
    """Rows (doc_id, bytes, shard, depth, part, shard_bytes, shard_docs), and row, all columns of docs, if carried."""
    store = Store(docs.sparkSession, "shard")
    own = {"doc_id": F.col("doc_id"), "bytes": byte_count(F.col("text")), "h": key_hash(F.col(key))}
    rows = held(docs, **own) if carry else docs.select(*[c.alias(n) for n, c in own.items()])
    rest = ["row"] * carry + ["doc_id", "bytes", "h"]
    rows = store.save(rows.select(*rest))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    base, bits = -1, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + 3)
    placed = None
    while True:
        directory = store.save(_directory(rows, base, bits, limit))
        # Some entries for each shard: Spark sends them to all tasks only while they are below its limit for that.
        joined = rows.withColumn("prefix", _prefix(F.col("h"), bits)).join(directory, "prefix")
        done = joined.filter("shard IS NOT NULL").select(*rest, "shard.*")
        placed = done if placed is None else placed.unionByName(done)
        if bits == BITS or directory.filter("shard IS NULL").isEmpty():
            break
        rows = store.save(joined.filter("shard IS NULL").select(*rest))
        base, bits = bits, min(BITS, bits + STEP)
    placed = _parts(placed, limit, store)
    name = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(node), depth, '0')"))
    return placed.select(*rest[:-1], name.alias("shard"), F.col("depth").cast("int").alias("depth"), "part", "shard_bytes", "shard_docs")


def shard(docs: DataFrame, limit: int = 8 << 20, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, bytes, shard (its bits), depth, part, shard_bytes, shard_docs."""
    return _placed(docs, limit, key, carry=False)


def write_shards(docs: DataFrame, path: str, limit: int = 8 << 20, key: str = "doc_id") -> None:
    """Write the documents as one Parquet directory per shard and part, each row once.

    Rows keep their shard from the placing on: nothing is matched by ids. The
    folders are shard=…/part=…; a name that the documents have is led by "_".
    """
    names = []
    for name in ("shard", "part"):
        while name in docs.columns:
            name = "_" + name
        names.append(name)
    own = [F.col("row").getField(c).alias(c) for c in docs.columns]
    rows = _placed(docs, limit, key, carry=True).select(*own, F.col("shard").alias(names[0]), F.col("part").alias(names[1]))
    rows.repartition(*names).write.partitionBy(*names).parquet(path)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, COALESCE(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h
  FROM documents),
n AS (
  SELECT depth, h >> ({BITS} - depth) AS node, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM d, (SELECT unnest(range(0, 41))::INT AS depth) GROUP BY ALL),
p AS (
  SELECT d.doc_id, d.bytes, n.depth, n.node, n.shard_bytes, n.shard_docs,
         row_number() OVER (PARTITION BY d.doc_id ORDER BY n.depth) AS k
  FROM d JOIN n ON n.node = d.h >> ({BITS} - n.depth)
  WHERE n.shard_bytes <= LIMIT_BYTES OR n.shard_docs = 1)
SELECT doc_id, bytes,
       CASE WHEN depth = 0 THEN '' ELSE right(repeat('0', 60) || bin(node), depth) END AS shard,
       depth, 0::BIGINT AS part, shard_bytes, shard_docs
FROM p WHERE k = 1
"""


def oracle(limit: int = 8 << 20) -> str:
    """DuckDB SQL for shard() over documents with distinct ids."""
    return ORACLE.replace("LIMIT_BYTES", str(limit))
