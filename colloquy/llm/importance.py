"""Quality filtering by importance resampling over hashed n-grams, sampled by Gumbel top-k.

Generative bag-of-n-gram models (word unigrams, word bigrams, byte trigrams,
each hashed) are counted: for raw text over all documents, for target text over
labelled documents of good quality without toxic ones, and for the two kinds of
labelled rejects. Raw text is the mixture of what all documents look like and
of both kinds of rejects. A document's log importance weight is its log
probability under the target model less that under the mixture. With Gumbel
noise added, the top k keys are a sample without replacement in proportion to
the weights; k is the number of documents whose log weight is above a level.
One labelled document in TUNING is left out of the models, and the level is
where these are told apart best: where the share of target ones above it and
that of rejects below it add up to the most.

A rare n-gram moves the target's ratio to raw text by CLIP at most, so that
what a few documents repeat, and no labelled one happens to hold, doesn't
decide. The toxic model is the target model but for the unigrams that far more
of its documents have, significantly so, by both of two hashes, each counted
once in a document; ordinary words don't add noise to a decision that few words
make, and words that share a place with a telling one don't count for it.

Labels are used up to `max_labels` rows, chosen by hash; corpus counts and
scores cover every document.

Edge cases: null, empty and white-space texts hold no n-gram, weigh 0 and are
not kept; a doc_id with several label rows takes the lower quality and the
higher toxicity, null labels are left out; repeated rows are scored alike and
rows tied at the cut are kept or dropped together; without labelled target
text nothing is known and every document with words is kept; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import held, id_text, lean, map_batches, released
from .store import Store

UNI, BI, TRI = 1 << 16, 1 << 15, 1 << 15
#: Places: unigrams by one hash and by another, bigrams, trigrams.
STARTS = (0, UNI, 2 * UNI, 2 * UNI + BI, 2 * UNI + BI + TRI)
SIZE = STARTS[-1]
#: Labelled documents used at most.
MAX_LABELS = 20_000
#: Strength of the raw model as a prior of the others, in n-grams.
PRIOR = 50_000.0
#: Standard errors by which a unigram's share of toxic documents has to exceed the target's to count.
Z_TOXIC = 4.5
#: Times that a unigram's share of toxic documents has to be its share of target ones.
TIMES_TOXIC = 10.0
#: Share of toxic documents that have to have it: what only copies of one document share is no sign.
SHARE_TOXIC = 0.015
#: Bound of an n-gram's log ratio of target to raw text, where fewer than COMMON are expected in the target's sample.
CLIP, COMMON = 0.3, 500
#: Log weight above which documents count towards k where labels don't tell: the mixture explains them no better.
LEVEL = 0.0
#: One labelled document in so many sets the level, and is not in the models.
TUNING = 5
_KINDS = ("raw", "target", "junk", "toxic", "target_docs", "toxic_docs")
#: Log odds against a document being of low quality or toxic, on top of their shares.
MARGINS = (4.0, 2.0)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SHUFFLE = np.uint32(2654435761)


def features(text: str | None) -> np.ndarray:
    """Places of a text's n-grams, repeats included."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    uni = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    a, b = uni[:-1], uni[1:]
    # A word that follows itself is one feature, whichever the word.
    bi = np.where(a == b, np.uint32(0), (a * np.uint32(31) + b) * _SHUFFLE >> np.uint32(17)).astype(np.int64)
    raw = np.frombuffer(b" ".join(data.split()), np.uint8).astype(np.uint32)
    tri = (((raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]) * _SHUFFLE) >> np.uint32(17)
    other = (uni * _SHUFFLE) >> np.uint32(16)
    return np.concatenate(((uni % UNI).astype(np.int64), STARTS[1] + other.astype(np.int64), STARTS[2] + bi, STARTS[3] + tri.astype(np.int64)))


def _counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of n-gram counts: place and _KINDS, the last two counting documents."""
    schema = "place int, " + ", ".join(f"{n} long" for n in _KINDS)

    def run(batches):
        counts = np.zeros((len(_KINDS), SIZE), np.int64)
        for batch in batches:
            for text, kind in zip(batch["text"], batch["kind"]):
                places, times = np.unique(features(text), return_counts=True)
                counts[0, places] += times
                if kind > 0:
                    counts[kind, places] += times
                if kind in (1, 3):
                    counts[4 if kind == 1 else 5, places] += 1
        some = np.flatnonzero(counts[0])
        yield pd.DataFrame({"place": some, **{n: counts[i, some] for i, n in enumerate(_KINDS)}})

    # At most MAX_LABELS ids of labelled rows: a bounded broadcast.
    kinds = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id", "left").select("text", F.coalesce("kind", F.lit(0)).alias("kind"))
    parts = kinds.mapInPandas(lean(run), schema)
    return parts.groupBy("place").agg(*[F.sum(n).alias(n) for n in _KINDS])


def _label_kinds(labels: DataFrame, max_labels: int) -> DataFrame:
    """(doc_id, kind): 1 target, 2 low quality, 3 toxic."""
    clean = labels.select("doc_id", "quality", "toxic").dropna()
    each = clean.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    kind = F.when(F.col("quality") == 0, 2).when(F.col("toxic") == 1, 3).otherwise(1)
    return each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).select("doc_id", kind.alias("kind"))


def _tuning(kinds: DataFrame):
    return F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(TUNING)) == 0


def best_level(weights: np.ndarray, target: np.ndarray) -> float:
    """The smallest level that tells target documents from the others best; LEVEL where there are none of either."""
    if target.all() or not target.any():
        return LEVEL
    order = np.argsort(weights, kind="stable")
    w, good = weights[order], target[order]
    # With the first n at or below the level: rejects among them, and target ones among the rest.
    told = np.concatenate(([0.0], np.cumsum(~good) / (~good).sum())) + np.concatenate(([1.0], 1 - np.cumsum(good) / good.sum()))
    ends = np.concatenate(([True], np.append(w[1:] != w[:-1], True)))
    n = int(np.argmax(np.where(ends, told, -1)))
    return float(w[0] - 1) if n == 0 else float(w[n - 1])


class Model:
    """Log ratios to the raw model, per n-gram: of target, of low quality, and of toxic to target."""

    def __init__(self, counts: np.ndarray, labelled: tuple[int, int, int]):
        """counts: _KINDS by place; labelled: documents of target, low quality and toxic kind."""
        self.known = counts[1].sum() > 0
        self.target, self.junk, self.toxic = (np.zeros(SIZE) for _ in range(3))
        for lo, hi in zip(STARTS, STARTS[1:]):
            raw, target, junk, _, target_docs, toxic_docs = counts[:, lo:hi].astype(np.float64)
            base = (raw + 0.5) / (raw.sum() + 0.5 * (hi - lo))
            rate = lambda c: (c + PRIOR * base) / (c.sum() + PRIOR)
            bound = np.where(base * target.sum() < COMMON, CLIP, np.inf)
            self.target[lo:hi] = np.clip(np.log(rate(target) / base), -bound, bound)
            self.junk[lo:hi] = np.log(rate(junk) / base)
            if lo == UNI:
                self.target[lo:hi] = self.junk[lo:hi] = 0.0
            if lo <= UNI:
                share = (target_docs + 0.5) / (labelled[0] + 1)
                expected = share * labelled[2]
                times = (toxic_docs + 0.5) / (labelled[2] + 1) / share
                strange = (toxic_docs - expected > Z_TOXIC * np.sqrt(expected + 0.5)) & (times > TIMES_TOXIC) & (toxic_docs >= SHARE_TOXIC * labelled[2])
                self.toxic[lo:hi] = np.where(strange, np.log(times), 0.0)
        self.log_shares = tuple(math.log(max(1e-6, n / max(1, sum(labelled)))) - margin for n, margin in zip(labelled[1:], MARGINS))

    def weight(self, places: np.ndarray) -> float:
        """Log importance weight."""
        target = self.target[places].sum()
        n = np.count_nonzero(places < UNI)
        a, b = self.toxic[places[:n]], self.toxic[places[n : 2 * n]]
        # What shares a place by one hash doesn't by the other: the two ratios are separate evidence.
        telling = np.flatnonzero((a > 0) & (b > 0))
        signs = {(places[i], places[n + i]): a[i] + b[i] for i in telling.tolist()}
        toxic = target + sum(signs.values()) + self.log_shares[1]
        return float(target - np.logaddexp.reduce([0.0, self.junk[places].sum() + self.log_shares[0], toxic]))


def fit(docs: DataFrame, labels: DataFrame, store: Store, max_labels: int = MAX_LABELS) -> Model:
    """Count all documents and make the model; SIZE rows at most come to the driver."""
    kinds = _label_kinds(labels, max_labels)
    kinds = store.save(kinds.filter(~_tuning(kinds)))
    n = {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}
    counts = np.zeros((len(_KINDS), SIZE), np.int64)
    found = _counts(docs, kinds).toPandas()
    counts[:, found["place"].to_numpy()] = found[list(_KINDS)].to_numpy().T
    return Model(counts, (n.get(1, 0), n.get(2, 0), n.get(3, 0)))


def score(docs: DataFrame, model: Model, seed: int = 11) -> DataFrame:
    """Rows (doc_id, digest, n_features, log_weight, key); digest is of the text, key is null without features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            found = [features(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": batch["digest"], "n_features": [len(f) for f in found], "log_weight": [m.weight(f) if m.known else 1.0 * bool(len(f)) for f in found]})

    schema = docs.select("doc_id").schema.add("digest", "long").add("n_features", "long").add("log_weight", "double")
    rows = map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("digest")), run, schema)
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    return rows.withColumn("key", F.when(F.col("n_features") > 0, F.col("log_weight") - F.log(-F.log(uniform))))


def kth_largest(rows: DataFrame, column: str, k: int, few: int = 4096) -> float | None:
    """The k-th largest value of a column, exactly, by counting in ever finer bins."""
    if k <= 0:
        return None
    c = F.col(column)
    low, high = rows.agg(F.min(column), F.max(column)).first()
    rank = k
    while True:
        inside = rows.filter(c.between(low, high))
        if low == high:
            return low
        width = (high - low) / 1024
        binned = inside.groupBy(F.least(F.lit(1023), F.floor((c - F.lit(low)) / F.lit(width))).alias("bin"))
        bins = binned.agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for b in sorted(bins, key=lambda b: -b["bin"]):
            if rank <= b["n"]:
                break
            rank -= b["n"]
        low, high = b["low"], b["high"]
        if b["n"] <= few:
            values = sorted((r[0] for r in rows.filter(c.between(low, high)).select(column).collect()), reverse=True)
            return values[rank - 1]


def resample(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, digest, n_features, log_weight, kept."""
    store = Store(docs.sparkSession, "importance")
    rows = store.save(score(docs, fit(docs, labels, store, max_labels), seed))
    kinds = _label_kinds(labels, max_labels)
    # At most max_labels / TUNING ids are broadcast, and their documents' weights come to the driver.
    tuned = rows.filter("n_features > 0").join(F.broadcast(kinds.filter(_tuning(kinds))), "doc_id").groupBy("doc_id", "kind").agg(F.min("log_weight").alias("w")).toPandas()
    level = best_level(tuned["w"].to_numpy(np.float64), tuned["kind"].to_numpy() == 1)
    k = rows.filter((F.col("n_features") > 0) & (F.col("log_weight") > level)).count()
    cut = kth_largest(rows.filter("key IS NOT NULL"), "key", k)
    kept = F.lit(False) if cut is None else F.coalesce(F.col("key") >= F.lit(cut), F.lit(False))
    return rows.select("doc_id", "digest", "n_features", "log_weight", kept.alias("kept"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the sample holds; rows of one id and text stay or go together."""
    kept = resample(docs, labels).filter("kept").select(id_text(F.col("doc_id")).alias("id"), "digest").distinct()
    rows = held(docs, id=id_text(F.col("doc_id")), digest=F.xxhash64("text"))
    return released(rows.join(kept, ["id", "digest"], "left_semi"), docs.columns)
