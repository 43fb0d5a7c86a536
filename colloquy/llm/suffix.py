"""Removal of repeated substrings by prefix doubling over sampled suffixes.

Every byte goes that lies in a string of LENGTH bytes which also starts
anywhere else, in the same document or another.

Sampling thins the start. Among the starts inside each window of LENGTH bytes
the one whose GRAM bytes have the smallest hash is the window's anchor
(leftmost if equal); equal windows have equal anchors at equal offsets. Anchors
with a unique gram drop out with all of their windows. Where all the bytes that
an anchor's windows cover are found again (by 128 bits of hash), all these
windows repeat. What is left are anchors whose surroundings differ, at the edges
of repeats: one of each class goes on to the doubling.

Doubling looks at a grid of positions, GRID bytes apart and aligned to the
anchor, over all that its windows cover. Spark sorts the positions by a 128-bit
name of their first START bytes and ranks them; a position's rank is the
smallest position with the same name, and unique positions drop out. Then it
sorts pairs of a rank and the rank an offset further on, and ranks the positions
anew by these, from 64 to 128 to 176 bytes. With the bytes before and behind,
that differ from window to window, these are windows of LENGTH bytes.

Exact copies of whole texts count once in all this and are removed as such.

Edge cases: a null text is empty; texts below LENGTH bytes lose nothing; equal
texts of LENGTH bytes or more lose everything; repeated rows are documents of
their own; long texts are read in overlapping segments; an empty table gives an
empty result; other columns are ignored by removals() and kept by cut_texts(),
whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import held, id_text, lean, map_batches, released
from .store import Store

LENGTH = 200
GRAM = 50
#: Window starts looked at together; bounds memory for long texts.
SEGMENT = 1 << 20
#: Positions of the doubling are so many bytes apart, and as many windows share one.
GRID = 16
#: Bytes of the first ranks, and how much further on the second rank of a pair is in each round.
START, STEPS = 64, (64, 48)
#: Bytes that the last ranks stand for.
CORE = START + sum(STEPS)
_POS = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _Tables:
    def __init__(self):
        #: Values of bytes, for two hashes that have nothing in common.
        self.bytes = np.random.default_rng(20).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.grow(1 << 14)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)


_tables: list[_Tables] = []


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Names:
    """Names of any stretch of one text segment; they don't depend on where it lies."""

    def __init__(self, data: np.ndarray, which: int = 0):
        if not _tables:
            _tables.append(_Tables())
        t = _tables[0]
        if len(t.up) <= len(data):
            t.grow(2 * len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(t.bytes[which][data] * t.up[: len(data)], out=self.sums[1:])
        self.down = t.down

    def all(self, length: int) -> np.ndarray:
        """Of every stretch of a length."""
        n = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:n]) * self.down[:n])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))


def _segments(data: bytes, length: int):
    """(offset, bytes) of segments that hold SEGMENT window starts each."""
    for at in range(0, max(0, len(data) - length + 1), SEGMENT):
        yield at, np.frombuffer(data, np.uint8, count=min(SEGMENT + length - 1, len(data) - at), offset=at)


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Anchors of a text: name; cover and cover2, two hashes of all bytes under the windows it anchors; place.

    A place is the first window's start, how far the anchor is from it, and the
    number of further windows, packed in 48, 8 and 8 bits.
    """
    found = []
    for at, part in _segments(data, length):
        names = Names(part)
        grams = names.all(gram)
        key = (grams & ~_POS) | np.arange(len(grams), dtype=np.uint64)
        wide, reach = length - gram + 1, 1
        while 2 * reach <= wide:
            key, reach = np.minimum(key[:-reach], key[reach:]), 2 * reach
        if reach < wide:
            key = np.minimum(key[: len(key) - (wide - reach)], key[wide - reach :])
        owner = (key & _POS).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1))
        last = np.concatenate((first[1:] - 1, [len(owner) - 1]))
        anchor = owner[first]
        lead = _mix((anchor - first).astype(np.uint64))
        covers = [n.of(first, last + length) + lead for n in (names, Names(part, 1))]
        found.append((grams[anchor], *covers, (first + at) << 16 | (anchor - first) << 8 | (last - first)))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.uint64)] * 3 + [np.zeros(0, np.int64)]
    return dict(zip(("name", "cover", "cover2", "place"), columns))


def grids(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The grid of some anchors: of each position which anchor it is of, its number there, and its place in the text;
    and the least and most bytes by which windows start before it (least > most where none does)."""
    start, lead, span = places >> 16, places >> 8 & 255, places & 255
    low, high = (lead - span) // GRID, lead // GRID
    counts = high - low + 1 + (CORE - START) // GRID
    which = np.repeat(np.arange(len(places)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    before = GRID * (high[which] - number)
    position = (start + lead)[which] - before
    least = np.maximum((lead - span)[which] - before, 0)
    most = np.where(number <= (high - low)[which], np.minimum(lead[which] - before, GRID - 1), -1)
    return which, number, position, least, most


#: Rows that a task gathers before it hands them on.
_HANDED = 200_000


class _Gathered:
    """Columns of many texts, handed on in large frames."""

    def __init__(self):
        self.parts: list[dict[str, np.ndarray]] = []
        self.rows = 0

    def add(self, columns: dict[str, np.ndarray], **same: int) -> None:
        n = len(columns["place"])
        whole = {k: v.view(np.int64) if v.dtype != object else v for k, v in columns.items()}
        self.parts.append(whole | {k: np.full(n, v, np.int64) for k, v in same.items()})
        self.rows += n

    def frames(self, least: int = 1):
        if self.rows >= least:
            yield pd.DataFrame({k: np.concatenate([p[k] for p in self.parts]) for k in self.parts[0]})
            self.parts, self.rows = [], 0


#: Texts that a task remembers as seen.
_SEEN = 100_000


def _anchor_rows(batches):
    seen, out = set(), _Gathered()
    for batch in batches:
        for text, digest, check in zip(batch["text"], batch["digest"].tolist(), batch["check"].tolist()):
            data = (text or "").encode("utf-8", "surrogatepass")
            # Copies that one task meets count once, as they do in what follows.
            if len(data) >= LENGTH and (digest, check) not in seen:
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add((digest, check))
                out.add(anchors(data), digest=digest, check=check)
                yield from out.frames(_HANDED)
    yield from out.frames()


def _grid_rows(batches):
    """Positions with their first bytes, and for those that windows share: the window starts, the bytes before and behind."""
    out, named = _Gathered(), TaskContext.get().partitionId() << 33
    for batch in batches:
        for text, digest, check, places in zip(batch["text"], batch["digest"].tolist(), batch["check"].tolist(), batch["places"]):
            data = text.encode("utf-8", "surrogatepass")
            places = np.sort(np.asarray(places, np.int64))
            for at, part in _segments(data, LENGTH):
                own = places[(places >> 16 >= at) & (places >> 16 < at + SEGMENT)]
                names = [Names(part, k) for k in (0, 1)] if len(own) else []
                for lo in range(0, len(own), 4096):
                    which, number, position, least, most = grids(own[lo : lo + 4096])
                    before, behind = np.full(len(which), None, object), np.full(len(which), None, object)
                    for k in np.flatnonzero(most >= least).tolist():
                        p = int(position[k])
                        before[k] = data[p - int(most[k]) : p]
                        behind[k] = data[p + CORE : p + LENGTH - int(least[k])]
                    columns = {f"n{k}": n.of(position - at, position - at + START) for k, n in enumerate(names)}
                    columns |= {"id": (named + which) << 6 | number, "place": position << 16 | least << 8 | (most & 255), "before": before, "behind": behind}
                    out.add(columns, digest=digest, check=check)
                    named += len(own[lo : lo + 4096])
                    yield from out.frames(_HANDED)
    yield from out.frames()


_GRID_SCHEMA = "n0 long, n1 long, id long, place long, before binary, behind binary, digest long, check long"


def _settle(rows: DataFrame, name: list[str], cover: list[str], store: Store) -> tuple[DataFrame, DataFrame]:
    """One round over rows (name and cover columns, digest, check, place): drops unique names.

    Returns (digest, check, place), place being null but for members of repeated
    covers, and of each cover whose name has others too one row (name, cover, digest, check, place).
    """
    it = F.xxhash64("digest", "check", "place")
    kind = F.xxhash64(*cover) if cover else F.lit(0)
    names = rows.groupBy(*name).agg(F.min(it).alias("a"), F.max(it).alias("b"), F.min(kind).alias("c"), F.max(kind).alias("d"))
    names = store.save(names.filter("a <> b").select(*name, (F.col("c") != F.col("d")).alias("mixed")))
    left = store.save(rows.join(names, name))
    key, one = [*name, *cover], F.struct("digest", "check", "place")
    classes = left.groupBy(*key, "mixed").agg((F.min(it) != F.max(it)).alias("repeated"), F.min_by(one, it).alias("one"))
    classes = store.save(classes.select(*key, "mixed", "repeated", "one.*"))
    # Every row is met with its class, so what the join makes grows with the rows and not with how often covers repeat.
    members = left.join(classes.select(*key, "repeated"), key).select("digest", "check", F.when(F.col("repeated"), F.col("place")).alias("place"))
    members = store.save(members)
    store.free(left, names)
    return members, classes.filter("mixed").select(*key, "digest", "check", "place")


def _ranked_pairs(rows: DataFrame, key: list[str], step: int, store: Store) -> DataFrame:
    """One round of doubling over rows (key columns, id): positions with equal keys get one rank, unique ones drop out.

    Returns (first, second, id): the rank of a position and of that `step` grid
    places further on around the same anchor, where both are left.
    """
    ranks = rows.groupBy(*key).agg(F.min("id").alias("rank"), F.max("id").alias("last")).filter("rank <> last")
    ranks = store.save(ranks.select(*key, "rank"))
    # The places of one anchor are some dozens at most.
    ahead = Window.partitionBy(F.shiftright("id", 6)).orderBy("id").rangeBetween(step, step)
    ranked = rows.select(*key, "id").join(ranks, key).select(F.col("rank").alias("first"), F.first("rank").over(ahead).alias("second"), "id")
    pairs = store.save(ranked.filter("second IS NOT NULL"))
    store.free(ranks)
    return pairs


def _doubled(rows: DataFrame, store: Store) -> DataFrame:
    """Rows (first, second, place, before, behind, digest, check) of the shared positions whose CORE bytes may repeat."""
    pairs, key = rows, ["n0", "n1"]
    for step in STEPS:
        more = _ranked_pairs(pairs, key, step // GRID, store)
        if pairs is not rows:
            store.free(pairs)
        pairs, key = more, ["first", "second"]
    shared = rows.filter("before IS NOT NULL").select("id", "place", "before", "behind", "digest", "check")
    return store.save(pairs.join(shared, "id").drop("id"))


def repeated_spans(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What to remove from texts (id, text, digest, check): per distinct text (digest, check, places), places being packed
    windows; and the texts that go whole (digest, check)."""
    store = Store(texts.sparkSession, "suffix")
    texts = texts.select("id", "text", "digest", "check")
    long_ones = texts.filter(F.octet_length("text") >= LENGTH)
    key = ["digest", "check"]
    distinct = store.save(long_ones.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")))

    rows = store.save(texts.drop("id").mapInPandas(lean(_anchor_rows), "name long, cover long, cover2 long, place long, digest long, check long"))
    first, mixed = _settle(rows, ["name"], ["cover", "cover2"], store)
    store.free(rows)

    wanted = mixed.groupBy(*key).agg(F.collect_set("place").alias("places"))
    wanted = store.save(wanted.join(distinct.select(*key, "id"), key))
    # One document of each text: the id keeps its copies, which may be very many, from meeting in one task.
    carried = long_ones.join(wanted, [*key, "id"]).select("text", *key, "places").dropDuplicates(key)
    rows = store.save(carried.mapInPandas(lean(_grid_rows), _GRID_SCHEMA))
    doubled = _doubled(rows, store)
    store.free(rows, wanted)
    cores = doubled.withColumn("reach", F.col("place").bitwiseAND(F.lit(0xFFFF))).withColumn("place", _windows("place"))
    second, mixed = _settle(cores, ["first", "second"], ["before", "behind", "reach"], store)
    store.free(doubled)

    # Windows whose group has no equal: each by itself, as the shared bytes and those around them.
    least, most = F.shiftright("reach", 8), F.col("reach").bitwiseAND(F.lit(255))
    each = mixed.withColumn("u", F.explode(F.sequence(least, most)))
    near = F.expr("substring(before, length(before) - CAST(u AS INT) + 1, CAST(u AS INT))")
    far = F.expr(f"substring(behind, 1, {LENGTH - CORE} - CAST(u AS INT))")
    # place is that of the first window, which starts `most` bytes before the position.
    start = F.shiftleft(F.shiftright("place", 16) + most - F.col("u"), 16)
    rows = store.save(each.select("first", "second", "u", near.alias("near"), far.alias("far"), "digest", "check", start.alias("place")))
    third, _ = _settle(rows, ["first", "second", "u", "near", "far"], [], store)
    store.free(rows)

    every = first.unionByName(second).unionByName(third)
    # Null places are not collected.
    spans = every.groupBy("digest", "check").agg(F.collect_set("place").alias("places"))
    return spans, distinct.filter("n > 1").select(*key)


def _windows(place: str) -> Column:
    """The packed windows that share a grid position, from its place and their reach before it."""
    most, least = F.col(place).bitwiseAND(F.lit(255)), F.shiftright(place, 8).bitwiseAND(F.lit(255))
    return F.shiftleft(F.shiftright(place, 16) - most, 16).bitwiseOR(most - least)


def merged(places: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Maximal runs (start, stop) of bytes under packed windows."""
    if not len(places):
        return np.zeros((0, 2), np.int64)
    places = np.sort(places)
    start, stop = places >> 16, (places >> 16) + (places & 255) + length
    reach = np.maximum.accumulate(stop)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    return np.column_stack((start[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(reach) - 1]))]))


def cut(data: bytes, runs: np.ndarray) -> bytes:
    """data without the runs."""
    kept, at = [], 0
    for a, b in runs.tolist():
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept)


def _with_places(rows: DataFrame) -> DataFrame:
    """rows, which hold columns id, text, digest and check among others, with the places to cut and whether all goes."""
    spans, gone = repeated_spans(rows)
    store = Store(rows.sparkSession, "suffix-spans")
    key = ["digest", "check"]
    both = spans.join(gone.withColumn("whole", F.lit(True)), key, "full")
    # A text that goes whole needs no places.
    both = store.save(both.select(*key, F.when(F.col("whole").isNull(), F.col("places")).alias("places"), F.coalesce("whole", F.lit(False)).alias("whole")))
    return rows.join(both, key, "left")


def _keyed(doc_id: Column, text: Column) -> dict[str, Column]:
    """The id as text, and the columns that name a text by 128 bits of hash."""
    text = F.coalesce(text, F.lit(""))
    return {"id": id_text(doc_id), "text": text, "digest": F.xxhash64(text), "check": F.xxhash64(F.lit(1), text)}


def _runs(data: bytes, places, whole) -> np.ndarray:
    if whole is not None and bool(whole):
        return np.array([[0, len(data)]], np.int64)
    return merged(np.asarray(places if places is not None else [], np.int64))


def removals(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, places, whole in zip(batch["text"], batch["places"], batch["whole"]):
                data = (text or "").encode("utf-8", "surrogatepass")
                runs = _runs(data, places, whole)
                rows.append((len(data), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), hashlib.sha256(cut(data, runs)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    schema = docs.select("doc_id").schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    keyed = docs.select("doc_id", *[c.alias(n) for n, c in _keyed(F.col("doc_id"), F.col("text")).items()])
    return map_batches(_with_places(keyed), run, schema)


def cut_texts(docs: DataFrame) -> DataFrame:
    """The documents, all columns, without the repeated bytes; a character that is cut through goes whole."""

    @F.pandas_udf("string")
    def kept(text: pd.Series, places: pd.Series, whole: pd.Series) -> pd.Series:
        out = [cut(data, _runs(data, p, w)).decode("utf-8", "ignore") for data, p, w in zip((t.encode("utf-8", "surrogatepass") for t in text), places, whole)]
        return pd.Series(out, dtype=object)

    rows = _with_places(held(docs, **_keyed(F.col("doc_id"), F.col("text"))))
    new = F.when(F.col("row").getField("text").isNotNull(), kept("text", "places", "whole"))
    return released(rows.withColumn("row", F.col("row").withField("text", new)), docs.columns)
