"""Near-duplicates by the Jaccard similarity of word shingles: SimHash tries and MinHash bands propose, exact sets decide.

The fingerprints of the shingles are joined with themselves within BUDGET bits
by the tries of simhash, and those of a component meet. A similarity of 0.8
leaves fingerprints ten bits apart on average, which is more than tries can
take of very many texts; what lies beyond the budget is left to bands. Of BANDS
bands of ROWS minimums each, two sets of similarity s share at least one with
odds of 1 - (1 - s^ROWS)^BANDS: at 0.8, 0.04 % of pairs share none, and closer
ones fewer. Texts with equal sets are one class. Classes that share a band or a
component meet in a task, in pairs of cells where they are many, and are
compared by their whole sets, in a component only within the budget; two that
others link already need no comparison. Tasks return spanning forests, which
meet in the components.

Edge cases: null and empty texts, and texts without words, have the empty set
and are alike; fewer words than a shingle are one shingle; equal 64-bit hashes
count as equal shingles; rows with a null doc_id are kept as others are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .columns import lean, map_batches
from .components import components
from .descent import _whole_groups
from .simhash import fingerprint_of, first_of_each, shingle_hashes, trie_links
from .store import Store

BANDS, ROWS = 20, 5
#: Bits by which fingerprints differ at most that the tries propose.
BUDGET = 6
#: Classes of a cell.
CELL = 256


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted."""
    return np.unique(shingle_hashes(text, width))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _bands(shingles: np.ndarray) -> list[int]:
    """A hash of each band of minimums."""
    rng = np.random.default_rng(11)
    a, b = rng.integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64)
    a |= np.uint64(1)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for lo in range(0, len(shingles), 1024):
        least = np.minimum(least, (shingles[lo : lo + 1024, None] * a + b).min(axis=0))
    return [_signed(xxhash.xxh64_intdigest(band.tobytes(), k)) for k, band in enumerate(least.reshape(BANDS, ROWS))]


def _classes(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, digest, cls, fp, bands): digests of the text and of its set, its fingerprint, and the set's bands."""

    def run(batches):
        for batch in batches:
            hashes = [shingle_hashes(t, width) for t in batch["text"]]
            sets = [np.unique(h) for h in hashes]
            names = [_signed(xxhash.xxh64_intdigest(s.tobytes())) for s in sets]
            prints = [_signed(fingerprint_of(h)) for h in hashes]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": batch["digest"], "cls": names, "fp": prints, "bands": [_bands(s) for s in sets]})

    schema = docs.select("doc_id").schema.add("digest", "long").add("cls", "long").add("fp", "long").add("bands", ArrayType(LongType()))
    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("digest")), run, schema)


def _alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    few, many = sorted((len(a), len(b)))
    if few < similarity * many:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (few + many - both)


def _forest(sets: list[np.ndarray], similarity: float, prints: np.ndarray | None = None) -> list[int]:
    """Labels of the sets under the links among them; with fingerprints, only links within the budget are looked for."""
    label = np.arange(len(sets))
    for step in range(1, len(sets)):
        if not label.any():
            break
        apart = label[:-step] != label[step:]
        if prints is not None:
            apart &= np.bitwise_count(prints[:-step] ^ prints[step:]) <= BUDGET
        for i in np.flatnonzero(apart).tolist():
            x, y = sorted((int(label[i]), int(label[i + step])))
            if x != y and _alike(sets[i], sets[i + step], similarity):
                label[label == y] = x
    return label.tolist()


def links(docs: DataFrame, rows: DataFrame, store: Store, width: int, similarity: float) -> DataFrame:
    """Edges (a, b) that span the links of classes in rows, which come from _classes."""
    one = rows.groupBy("cls").agg(F.min("digest").alias("digest"), F.min_by("fp", "digest").alias("fp"), F.first("bands").alias("bands"))
    one = store.save(one)
    # Components of fingerprints are groups as bands are, in which only pairs within the budget are compared.
    prints = store.save(one.select("fp").distinct())
    near = components(trie_links(prints, BUDGET), store).withColumnRenamed("node", "fp")
    tried = one.join(near, "fp", "left").select("cls", "digest", "fp", F.xxhash64(F.coalesce("root", "fp"), F.lit("tries")).alias("band"), F.lit(True).alias("tries"))
    banded = one.select("cls", "digest", "fp", F.explode("bands").alias("band"), F.lit(False).alias("tries"))
    placed = store.save(tried.unionByName(banded))
    mark = F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("mark")
    shared = placed.groupBy("band", "tries").agg(F.count(F.lit(1)).alias("count"), mark).filter("count > 1")
    # Groups with the same members are compared once, by a band if one is among them: it compares all pairs.
    shared = shared.groupBy("mark", "count").agg(F.min(F.struct("tries", "band")).alias("first"))
    shared = store.save(shared.select("first.band", "first.tries", F.ceil(F.col("count") / F.lit(float(CELL))).cast("long").alias("cells")))
    dealt = placed.join(shared, ["band", "tries"]).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("cells")))
    dealt = store.save(dealt)
    wanted = dealt.select("cls", "digest").distinct()
    texts = docs.select(F.xxhash64("text").alias("digest"), "text").join(wanted, "digest", "left_semi").dropDuplicates(["digest"])

    def hashes(batches):
        for batch in batches:
            yield pd.DataFrame({"digest": batch["digest"], "held": [shingle_set(t, width).tobytes() for t in batch["text"]]})

    sets = store.save(texts.mapInPandas(lean(hashes), "digest long, held binary"))
    met = dealt.withColumn("other", F.explode(F.expr("sequence(0L, cells - 1)")))
    met = met.select("cls", "digest", "fp", "tries", F.xxhash64("band", "tries", F.least("own", "other"), F.greatest("own", "other")).alias("group")).join(sets, "digest")
    met = met.select("group", "tries", "cls", "fp", "held").repartition("group").sortWithinPartitions("group", "cls")

    def run(batches):
        for batch in _whole_groups(batches, "group", 256):
            a, b = [], []
            for _, group in batch.groupby("group"):
                names = group["cls"].tolist()
                prints = group["fp"].to_numpy(np.int64).view(np.uint64) if group["tries"].iloc[0] else None
                label = _forest([np.frombuffer(x, np.uint64) for x in group["held"]], similarity, prints)
                a += [names[i] for i, x in enumerate(label) if x != i]
                b += [names[x] for i, x in enumerate(label) if x != i]
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return met.mapInPandas(lean(run), "a long, b long")


def keep_first(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each component of similar documents, all columns: that with its smallest doc_id."""
    store = Store(docs.sparkSession, "resemblance")
    rows = store.save(_classes(docs, width))
    labels = components(links(docs, rows, store, width, similarity), store)
    rooted = rows.select("doc_id", "digest", "cls").join(labels, F.col("cls") == F.col("node"), "left")
    return first_of_each(docs, rooted.select("doc_id", "digest", F.coalesce("root", "cls").alias("root")))
