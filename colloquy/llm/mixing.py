"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its weighted share of the words wanted. A document then
has a fractional number of copies, target over source size. Whole copies are
taken as they are; the fractions left are rounded in pairs: two documents of a
source move words between them until one holds none or all of itself, and the
other goes on. Each duel keeps the pair's words and every document's
expectation, so a source misses its target by less than one document. Buckets
of a source are reduced side by side, and what each leaves meets in a tree.

Edge cases: a null text has size 0 and is never taken (nor is any other text
without words); a null source is a
source, last in order; an empty table gives an empty result; repeated rows are
documents of their own; columns other than those named are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import held, id_text, released, row_hash, word_count
from .store import Store

#: Documents of one source that one task reduces at a time.
FAN = 512


def source_targets(stats: DataFrame, store: Store, weights=(1, 2, 3), share: float = 1.0, max_repeat: int = 3) -> DataFrame:
    """Targets of sources (source, source_size, n_docs), one row per source, without bringing the sources together.

    Weights repeat over the sources in code-point order, null last: places come
    from a range partitioning and the row counts of its partitions. A target
    stops at max_repeat times its source; the excess goes to the others by
    weight. The level, a target per weight, rises from none capped: each step
    caps the sources that it overflows and shares what they leave, and it ends
    when a step caps no more, after a few steps. Sums are of whole numbers, so
    reruns agree to the last bit.
    """
    order = F.col("source").asc_nulls_last()
    ranged = stats.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id())
    ranged = store.save(ranged)
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before, offsets = 0, []
    for r in ranged.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((r["part"], before))
        before += r["count"]
    # A row for each partition of the exchange, whatever the number of sources.
    offsets = stats.sparkSession.createDataFrame(offsets, "part long, before long")
    numbered = ranged.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("kind", ((F.col("before") + place) % len(weights)).cast("int"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = store.save(numbered.select("source", "source_size", "n_docs", F.get(listed, "kind").alias("weight"), "kind"))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap, wanted, level, seen = F.col("source_size").cast("double") * max_repeat, total * float(share), 0.0, -1
    while True:
        full = F.lit(False) if seen < 0 else (cap <= F.lit(level) * F.col("weight"))
        sums = ranked.groupBy(full.alias("full"), "kind").agg(F.sum("source_size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        capped, n_capped = (sum(r[c] for r in sums if r["full"]) for c in ("size", "n"))
        free = sum(r["n"] * float(weights[r["kind"]]) for r in sums if not r["full"])
        if n_capped == seen or not sums:
            break
        seen = n_capped
        level = (wanted - capped * float(max_repeat)) / free if free else float("inf")
    return ranked.select("source", "source_size", "n_docs", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def duel_all(sizes: np.ndarray, mass: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round the masses (words of each document to take, below its size) in turn.

    Returns which documents are taken whole, and the place of the one still
    fractional, or -1; mass is changed in place.
    """
    taken = np.zeros(len(sizes), dtype=bool)
    holder = -1
    for j in range(len(sizes)):
        if mass[j] <= 0:
            continue
        if mass[j] >= sizes[j]:
            taken[j] = True
            continue
        if holder < 0:
            holder = j
            continue
        up = min(sizes[holder] - mass[holder], mass[j])
        down = min(mass[holder], sizes[j] - mass[j])
        if draws[j] * (up + down) < down:
            gainer, loser, moved = holder, j, up
        else:
            gainer, loser, moved = j, holder, down
        full, dry = moved >= sizes[gainer] - mass[gainer], moved >= mass[loser]
        mass[gainer] += moved
        mass[loser] -= moved
        taken[gainer] |= full
        holder = (-1 if dry else loser) if full else gainer
    return taken, holder


def _reducer(level: int, last: bool, seed: int):
    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "size", "own", "nth"], kind="stable", na_position="last").reset_index(drop=True)
        source = group["source"].iloc[0]
        name = zlib.crc32(b"-" if source is None else b"+" + source.encode())
        rng = np.random.default_rng([seed, level, int(group["bucket"].iloc[0]), name])
        sizes, mass = group["size"].to_numpy(np.float64), group["mass"].to_numpy(np.float64).copy()
        taken, holder = duel_all(sizes, mass, rng.random(len(group)))
        open_ = np.zeros(len(group), dtype=bool)
        if holder >= 0:
            if last:
                taken[holder] = rng.random() * sizes[holder] < mass[holder]
            else:
                open_[holder] = True
        group["copies"] = group["copies"] + taken
        group["mass"], group["open"] = mass, open_
        return group

    return reduce


def mix(docs: DataFrame, weights=(1, 2, 3), share: float = 1.0, max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, source, and own, the hash of its row."""
    store = Store(docs.sparkSession, "mix")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_hash(docs).alias("own"))
    # Rows that are the same in every column are counted and numbered, so each has a name and reruns agree.
    same = sized.groupBy("doc_id", "source", "size", "own").agg(F.count(F.lit(1)).alias("times"))
    sized = store.save(same.withColumn("nth", F.explode(F.expr("sequence(1L, times)"))).drop("times"))
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = store.save(source_targets(stats, store, weights, share, max_repeat))
    largest = targets.agg(F.max("n_docs")).first()[0] or 0

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    open_rows = (
        sized.alias("d")
        .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select(F.col("d.doc_id").cast("string").alias("doc_id"), "d.source", "d.size", "d.own", "d.nth", "t.source_size", "t.target", F.col("t.n_docs").alias("n"), rate.alias("rate"))
        .withColumn("copies", F.when(F.col("size") > 0, F.floor("rate")).otherwise(F.lit(0)).cast("long"))
        .withColumn("mass", (F.col("rate") - F.floor("rate")) * F.col("size"))
        .drop("rate")
    )
    settled, level = [], 0
    while True:
        last = largest <= FAN
        buckets = F.ceil(F.col("n") / F.lit(float(FAN))).cast("long")
        spread = F.xxhash64("doc_id", "size", "own", "nth", F.lit(level))
        keyed = open_rows.withColumn("n", F.greatest(buckets, F.lit(1))).withColumn("bucket", F.pmod(spread, F.col("n")))
        schema = "doc_id string, source string, size long, own long, nth long, source_size long, target double, n long, copies long, mass double, bucket long, open boolean"
        done = keyed.groupBy("source", "bucket").applyInPandas(_reducer(level, last, seed), schema)
        if not last:
            done = store.save(done)
        settled.append(done.filter(~F.col("open")))
        if last:
            break
        open_rows = done.filter("open").drop("open", "bucket")
        largest, level = -(-largest // FAN), level + 1
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source", "own")


def apply_mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents, all columns, each as often as its plan takes it; plan is of mix() over the same documents.

    Rows that are the same in every column go together: one of them is written
    as often as the plan takes all of them.
    """
    taken = plan.groupBy(id_text(F.col("doc_id")).alias("id"), "own").agg(F.sum("copies").alias("times")).filter("times > 0")
    rows = held(docs, id=id_text(F.col("doc_id")), own=row_hash(docs))
    rows = rows.groupBy("id", "own").agg(F.first("row").alias("row")).join(taken, ["id", "own"])
    return released(rows.select("row", F.explode(F.expr("sequence(1L, times)"))), docs.columns)
