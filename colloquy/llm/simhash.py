"""SimHash near-duplicates: fingerprints, and links within a Hamming budget by a binary trie self-join.

A fingerprint holds, for each of 64 bits, whether over half of a text's shingle
hashes have it set. Fingerprints that differ in at most `budget` bits link.

Of budget + 1 blocks that cover the 64 bits, two linked fingerprints share at
least one whole, so each block in turn leads a trie in which the leading block
has no budget: its subtries are joined with themselves, node pair by node pair,
adding up differing bits and dropping a pair once they exceed the budget. More
and shorter blocks, several of them leading at once, keep subtries small when
there are very many fingerprints. A subtrie over `cell` fingerprints goes down
further levels of the trie, and what is still larger is dealt out as pairs of
cells. Each task returns a spanning forest of its links, never
the pairs themselves, and the forests meet in the components.

Edge cases: null and empty texts, and texts without words, have fingerprint 0
and link like any other; fewer words than a shingle hash as one shingle; a null
doc_id is kept and never names a component unless all of it is null; repeated
rows stay rows; an empty table gives an empty result; columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import held, id_text, lean, map_batches, released, row_hash
from .components import components
from .store import Store

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Node pairs with at most this many leaf pairs are compared leaf by leaf.
_LEAVES = 64
#: Node pairs that are expanded at once.
_CHUNK = 16384


def shingle_hashes(text: str | None, width: int = 4, seed: int = 42) -> np.ndarray:
    """The hash of each of a text's word shingles, in order, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), stops.tolist())), np.uint64, n)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set, as an unsigned integer; 0 of none."""
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[lo : lo + 8192].astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """The SimHash of a text's word shingles, as an unsigned integer."""
    return fingerprint_of(shingle_hashes(text, width, seed))


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """Rows (doc_id, digest, fp): a digest of the text, and the signed 64-bit fingerprint."""

    def run(batches):
        for batch in batches:
            values = np.fromiter((fingerprint(t, width, seed) for t in batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": batch["digest"], "fp": values.view(np.int64)})

    schema = docs.select("doc_id").schema.add("digest", "long").add("fp", "long")
    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("digest")), run, schema)


def block_plan(n: int, budget: int, target: int = 2048) -> list[list[tuple[int, int]]]:
    """Which bit blocks lead together: per trie a list of (shift, width); about target of n fingerprints share a lead."""
    for blocks in range(budget + 1, 2 * budget + 5):
        edges = [64 * i // blocks for i in range(blocks + 1)]
        lead = blocks - budget
        if 64 * lead // blocks >= np.log2(max(2, n / target)) or blocks == 2 * budget + 4:
            spans = [(64 - hi, hi - lo) for lo, hi in zip(edges, edges[1:])]
            return [list(c) for c in combinations(spans, lead)]
    raise AssertionError


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a and b in label, in which every entry points at its set's smallest."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _split(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where each range [lo, hi) of nodes, sorted and equal above bit, first has bit set."""
    left, right = lo.copy(), hi.copy()
    mask = np.uint64(1) << np.uint64(bit)
    while True:
        active = left < right
        if not active.any():
            return left
        mid = (left + right) >> 1
        one = np.zeros(len(lo), bool)
        one[active] = (x[mid[active]] & mask) != 0
        right = np.where(active & one, mid, right)
        left = np.where(active & ~one, mid + 1, left)


def trie_forest(x: np.ndarray, pairs: np.ndarray, budget: int) -> np.ndarray:
    """Labels of x under links within budget, found from node pairs (alo, ahi, blo, bhi) of the trie over x.

    Ranges of x are sorted; equal ranges stand for a node with itself.
    """
    label = np.arange(len(x))
    stack = [(63, np.column_stack((pairs, np.zeros(len(pairs), np.int64))))]
    while stack:
        bit, level = stack.pop()
        if len(level) > _CHUNK:
            stack += [(bit, level[_CHUNK:]), (bit, level[:_CHUNK])]
            continue
        na, nb = level[:, 1] - level[:, 0], level[:, 3] - level[:, 2]
        leaf = (na * nb <= _LEAVES) | (bit < 0)
        if leaf.any():
            some, count = level[leaf], (na * nb)[leaf]
            which = np.repeat(np.arange(len(some)), count)
            k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            width = nb[leaf][which]
            a, b = some[which, 0] + k // width, some[which, 2] + k % width
            near = (np.bitwise_count(x[a] ^ x[b]) <= budget) & (a < b)
            _merge(label, a[near], b[near])
        level = level[~leaf]
        if not len(level):
            continue
        alo, ahi, blo, bhi, spent = level.T
        amid = _split(x, alo, ahi, bit)
        same = (alo == blo) & (ahi == bhi)
        bmid = np.where(same, amid, _split(x, blo, bhi, bit))
        parts = [
            np.column_stack((alo, amid, blo, bmid, spent)),
            np.column_stack((amid, ahi, bmid, bhi, spent)),
            np.column_stack((alo, amid, bmid, bhi, spent + 1)),
            np.column_stack((amid, ahi, blo, bmid, spent + 1))[~same],
        ]
        nodes = np.concatenate(parts)
        nodes = nodes[(nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (nodes[:, 4] <= budget)]
        if len(nodes):
            stack.append((bit - 1, nodes))
    return label


def _forest_of(groups: pd.DataFrame, budget: int) -> pd.DataFrame:
    """Spanning edges (a, b) of whole groups (trie, lead, i, j), sorted so that a group's rows are together."""
    keys = groups[["trie", "lead", "i", "j"]].to_numpy()
    new = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
    group = np.cumsum(new)
    fp, side = groups["fp"].to_numpy(np.int64), groups["side"].to_numpy(np.int64)
    x = fp.view(np.uint64)
    order = np.lexsort((x, side, group))
    x, fp, group, side = x[order], fp[order], group[order], side[order]
    change = np.concatenate(([0], np.flatnonzero((group[1:] != group[:-1]) | (side[1:] != side[:-1])) + 1, [len(x)]))
    lo, hi, s, g = change[:-1], change[1:], side[change[:-1]], group[change[:-1]]
    own = s == 0
    pairs = [np.column_stack((lo[own], hi[own], lo[own], hi[own]))]
    second = np.flatnonzero((s[1:] == 2) & (s[:-1] == 1) & (g[1:] == g[:-1])) + 1
    pairs.append(np.column_stack((lo[second - 1], hi[second - 1], lo[second], hi[second])))
    label = trie_forest(x, np.concatenate(pairs).astype(np.int64), budget)
    moved = np.flatnonzero(label != np.arange(len(x)))
    return pd.DataFrame({"a": fp[moved], "b": fp[label[moved]]})


def _bits_at(spans: list[tuple[int, int]]) -> Column:
    """The bits of fp in some spans (shift, width), put together."""
    value, placed = F.lit(0).cast("long"), 0
    for shift, width in spans:
        part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        value, placed = value.bitwiseOR(F.shiftleft(part, placed)), placed + width
    return value


def _rest_in_blocks(lead: list[tuple[int, int]], blocks: int) -> list[list[tuple[int, int]]]:
    """The bits that are not in a lead, dealt into blocks of spans."""
    taken = {shift + i for shift, width in lead for i in range(width)}
    rest = [i for i in range(64) if i not in taken]
    out = []
    for k in range(blocks):
        some, spans = rest[len(rest) * k // blocks : len(rest) * (k + 1) // blocks], []
        for i in some:
            if spans and spans[-1][0] + spans[-1][1] == i:
                spans[-1] = (spans[-1][0], spans[-1][1] + 1)
            else:
                spans.append((i, 1))
        out.append(spans)
    return out


def _large(rows: DataFrame, cell: int) -> DataFrame:
    """(trie, lead, cells) of subtries with more than a cell's fingerprints."""
    large = rows.groupBy("trie", "lead").count().filter(F.col("count") > cell)
    return large.select("trie", "lead", F.ceil(F.col("count") / F.lit(float(cell))).cast("long").alias("cells"))


def trie_links(classes: DataFrame, budget: int, cell: int = 2048) -> DataFrame:
    """Edges (a, b) that span the links within budget between distinct fingerprints (column fp)."""
    n = classes.count()
    tries = block_plan(n, budget)
    leads = [F.struct(F.lit(k).alias("trie"), _bits_at(spans).alias("lead")) for k, spans in enumerate(tries)]
    rows = classes.select("fp", F.explode(F.array(*leads)).alias("k")).select("fp", "k.trie", "k.lead")
    first = rows.join(_large(rows, cell), ["trie", "lead"], "left")
    # A subtrie that very many fingerprints share goes down further levels: of the bits below its lead, dealt into
    # budget + 1 blocks, two linked fingerprints share one.
    deeper = None
    for k, spans in enumerate(tries):
        blocks = [F.struct(F.lit((k + 1) * 64 + j).alias("trie"), F.xxhash64("lead", _bits_at(block)).alias("lead")) for j, block in enumerate(_rest_in_blocks(spans, budget + 1))]
        own = F.array(*blocks)
        deeper = F.when(F.col("trie") == k, own) if deeper is None else deeper.when(F.col("trie") == k, own)
    below = first.filter("cells IS NOT NULL").select("fp", F.explode(deeper).alias("k")).select("fp", "k.trie", "k.lead")
    rows = first.filter("cells IS NULL").select("fp", "trie", "lead").unionByName(below)
    dealt = rows.join(_large(rows, cell), ["trie", "lead"], "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("cells"))).withColumn("other", F.explode(F.expr("sequence(0L, cells - 1)")))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    dealt = dealt.select("fp", "trie", "lead", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.cast("long").alias("side"))
    keys = ["trie", "lead", "i", "j"]

    def run(batches):
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = (rest[keys] == rest[keys].iloc[-1]).all(axis=1).to_numpy()
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut >= 4096:
                yield _forest_of(rest.iloc[:cut], budget)
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield _forest_of(rest, budget)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(lean(run), "a long, b long")


def _rooted(docs: DataFrame, width: int, budget: int, seed: int) -> DataFrame:
    """One row per document: doc_id, digest, fp, component_id, and root, a fingerprint that no other component has."""
    store = Store(docs.sparkSession, "simhash")
    rows = store.save(fingerprints(docs, width, seed))
    classes = store.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(trie_links(classes, budget), store)
    rooted = store.save(
        classes.join(labels, classes["fp"] == labels["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    )
    # Written first, so that the join may split a root that very many fingerprints have.
    least = store.save(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = store.save(rooted.join(least, "root").select("fp", "component_id", "root"))
    return rows.join(named, "fp").select("doc_id", "digest", "fp", "component_id", "root")


def near_duplicates(docs: DataFrame, width: int = 4, budget: int = 4, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, digest, fp (signed), component_id (smallest doc_id reachable by links)."""
    return _rooted(docs, width, budget, seed).drop("root")


def first_of_each(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """One document of each root in rooted (doc_id, digest, root), all columns.

    It is the one with the smallest doc_id, nulls last, then the smallest
    digest of its text, then the smallest hash of all its columns; of rows
    that agree in all of these one stays.
    """
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("least")
    # A digest has one root, so no two roots choose the same id and digest.
    first = rooted.groupBy("root").agg(least).select(id_text(F.col("least.doc_id")).alias("id"), F.col("least.digest").alias("digest"))
    rows = held(docs, id=id_text(F.col("doc_id")), digest=F.xxhash64("text"), own=row_hash(docs))
    # Partial minimums meet before the shuffle, so a row that is repeated very often is no load.
    chosen = rows.join(first, ["id", "digest"], "left_semi").groupBy("id", "digest").agg(F.min_by("row", "own").alias("row"))
    return released(chosen, docs.columns)


def keep_first(docs: DataFrame, width: int = 4, budget: int = 4) -> DataFrame:
    """One document of each component, all columns: that with its smallest doc_id."""
    return first_of_each(docs, _rooted(docs, width, budget, 42))
