"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Texts become token ids followed by an end id. Only texts above the capacity
are cut, into pieces of it; whole pieces are sequences of their own. The rest
is dealt into shards of SHARD pieces at most, and each shard is solved by
ISLANDS populations side by side. A solution is a list of bins. Crossover
injects whole well-filled bins of one parent into the other, takes out the
bins that then hold a piece twice and best-fits the pieces displaced; mutation
empties some of the poorest bins the same way. Populations live through all
epochs; after each an island's elite joins the next island. A shard that
reaches its lower bound stops.

A bin is settled if what it has free is below SLACK or below the smallest piece
still about, or if it is another than the worst of a shard that reached its
lower bound. What lies in the others is dealt anew into fewer shards and packed
again, level by level: poorly filled bins don't add up over the shards. Levels
end when nothing is left, when one shard was enough, or when less than a
quarter of the pieces got settled; then bins stay as they are. No task ever
holds more than the pieces of one shard at a time.

Edge cases: a null text is empty and packs as the end id alone; repeated rows
are documents of their own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .columns import lean, map_batches
from .store import Store

CAPACITY = 4096
END_ID = 1
#: Pieces of a shard at most, and on average: pieces are dealt by hash, and ten deviations lie between the two.
SHARD, DEALT = 1024, 3 / 4
ISLANDS = 3
EPOCHS = 4
GENERATIONS = 6
POPULATION = 6
#: Free tokens up to which a bin counts as full.
SLACK = 32
#: Bytes that a worker's memos of words and of their parts may take.
MEMO, PARTS_MEMO = 160 << 20, 24 << 20
#: Bytes of an entry beside its key and value: a slot of the table, and what objects take themselves.
_ENTRY = 140
#: Times that later keys are forgotten before all are.
TURNS = 32
#: Rows that a task hands on together.
_HANDED = 20_000

# --- tokens ---------------------------------------------------------------

_encoders: dict[str, "Encoder"] = {}
#: White space to Python, but not to the tokenizer.
_ODD = tuple(map(chr, range(0x1C, 0x20)))


#: A byte as the tokenizer's alphabet writes it: visible Latin-1 as itself, the others as what follows 255, in order.
_SHOWN = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173}
_ALPHABET = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - _SHOWN))}
#: Fixed value: how the tokenizer splits normalized text.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Memo(dict):
    """Values by key, worked out when a key is first met, in a bounded number of bytes.

    Three quarters of the bound are for the keys met first, frequent ones among
    them; the rest is for later keys, which are forgotten when it is full. After
    TURNS of that all is forgotten, so that a memo follows texts that change.
    """

    def __init__(self, work, limit: int):
        self.work, self.most, self.few = work, limit * 3 // 4, limit // 4
        self.young: dict = {}
        self.bytes = self.young_bytes = self.turns = 0

    def __missing__(self, key: str) -> bytes:
        value = self.young.get(key)
        if value is not None:
            return value
        value = self.work(key)
        size = _ENTRY + 4 * len(key) + len(value)
        if self.bytes + size <= self.most:
            self.bytes += size
            self[key] = value
            return value
        if self.young_bytes + size > self.few:
            self.young.clear()
            self.young_bytes, self.turns = 0, self.turns + 1
            if self.turns == TURNS:
                self.clear()
                self.bytes = self.turns = 0
        self.young_bytes += size
        self.young[key] = value
        return value


class Words:
    """Ids of words, as bytes.

    A word of Latin characters, whose normal form is its lower case, is split
    here and its parts go to the tokenizer's model; other words go through the
    whole tokenizer.
    """

    def __init__(self, tokenizer):
        import regex

        self.whole, self.model = tokenizer, tokenizer.model
        self.latin = re.compile("[!-~\xa1-\xac\xae-\u012f\u0131-\u024f]+").fullmatch
        self.split = regex.compile(_PARTS).findall
        self.packed = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        self.parts = Memo(self._part, PARTS_MEMO)
        self.ids = Memo(self._word, MEMO)

    def _part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(_ALPHABET)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(shown)])

    def _word(self, word: str) -> bytes:
        if not self.latin(word) or "<|" in word:
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if word.isalpha():
            # One part, and as many entries as words: it is remembered as a word only.
            return self._part(word.lower())
        return b"".join(map(self.parts.__getitem__, self.split(word.lower())))


class Encoder:
    """Ids of texts by a tokenizer that never joins across white space, word by word with a memo."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.words = Words(self.tokenizer)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text, with the end id."""
        end = END_ID.to_bytes(4, "little")
        if any(c in text for c in _ODD):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + end
        return b"".join(map(self.words.ids.__getitem__, text.split())) + end


def encoder(tokenizer_file: str) -> Encoder:
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = Encoder(tokenizer_file)
    return _encoders[tokenizer_file]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows (uid, doc_id, piece, start, length, ids_crc32); uid is unique but not the same in every run."""

    names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        tokens = encoder(tokenizer_file)
        uid, rows = TaskContext.get().partitionId() << 33, []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                data = tokens.encode("" if text is None else text)
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((uid, doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    uid += 1
                if len(rows) >= _HANDED:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        yield pd.DataFrame(rows, columns=names)

    schema = StructType().add("uid", "long").add(docs.schema["doc_id"])
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)
    return map_batches(docs.select("doc_id", "text"), run, schema)


# --- one shard ------------------------------------------------------------

Bins = list[list[int]]


class Shard:
    """The pieces of a shard, by their lengths, and what islands do with solutions over them."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths = lengths.tolist()
        self.capacity = capacity
        self.bound = -(-int(lengths.sum()) // capacity)

    def best_fit(self, bins: Bins, items: list[int]) -> Bins:
        """Put items, in order, where they leave least room; bins is used up."""
        free = sorted((self.capacity - sum(self.lengths[i] for i in b), k) for k, b in enumerate(bins))
        for i in items:
            need = self.lengths[i]
            at = bisect_left(free, (need, -1))
            if at < len(free):
                room, k = free.pop(at)
                bins[k].append(i)
                insort(free, (room - need, k))
            else:
                bins.append([i])
                insort(free, (self.capacity - need, len(bins) - 1))
        return bins

    def fitness(self, bins: Bins) -> tuple[int, float]:
        """Fewer bins first, then unevenly filled ones."""
        fill = [sum(self.lengths[i] for i in b) / self.capacity for b in bins]
        return -len(bins), sum(f * f for f in fill)

    def first(self, rng: np.random.Generator, noise: float) -> Bins:
        """Best fit in falling order of length, blurred by noise."""
        keys = np.asarray(self.lengths) * (1 + noise * rng.standard_normal(len(self.lengths)))
        return self.best_fit([], np.argsort(-keys, kind="stable").tolist())

    def _refit(self, bins: Bins, displaced: list[int]) -> Bins:
        return self.best_fit(bins, sorted(displaced, key=lambda i: -self.lengths[i]))

    def cross(self, into: Bins, giver: Bins, rng: np.random.Generator) -> Bins:
        """A copy of into with some of the giver's well-filled bins in it whole."""
        order = sorted(giver, key=lambda b: -sum(self.lengths[i] for i in b))
        good = order[: max(1, len(order) // 2)]
        chosen = [good[k] for k in rng.choice(len(good), max(1, len(good) // 3), replace=False)]
        held = {i for b in chosen for i in b}
        kept, displaced = [list(b) for b in chosen], []
        for b in into:
            if held.isdisjoint(b):
                kept.append(list(b))
            else:
                displaced += [i for i in b if i not in held]
        return self._refit(kept, displaced)

    def mutate(self, bins: Bins, rng: np.random.Generator) -> Bins:
        """A copy with its poorest bin and a few others emptied and refitted."""
        order = sorted(bins, key=lambda b: sum(self.lengths[i] for i in b))
        gone = {0, *rng.integers(0, len(order), min(3, len(order))).tolist()}
        displaced = [i for k in gone for i in order[k]]
        return self._refit([list(b) for k, b in enumerate(order) if k not in gone], displaced)

    def evolve(self, population: list[Bins], rng: np.random.Generator) -> list[Bins]:
        """GENERATIONS of crossover and mutation; best first, none twice as good as another."""
        ranked = sorted(population, key=self.fitness, reverse=True)
        for _ in range(GENERATIONS):
            if len(ranked[0]) <= self.bound:
                break
            a, b = rng.choice(len(ranked), 2, replace=False) if len(ranked) > 1 else (0, 0)
            children = [self.cross(ranked[a], ranked[b], rng), self.cross(ranked[b], ranked[a], rng)]
            children += [self.mutate(ranked[0], rng), self.mutate(ranked[int(rng.integers(len(ranked)))], rng)]
            # Of equally fit solutions one stays: a population of copies has nothing to cross.
            fit = {self.fitness(c): c for c in children + ranked}
            ranked = [fit[f] for f in sorted(fit, reverse=True)[:POPULATION]]
        return ranked


def _genome(bins: Bins, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def _bins(genome: np.ndarray) -> Bins:
    order = np.argsort(genome, kind="stable")
    return [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(genome[order])) + 1)]


_STATE = "shard long, island int, lengths array<int>, population array<array<int>>, n_bins int, first_bins int, bound int"


def _island(seed: int, capacity: int, epoch: int):
    """One epoch of islands: rows of _STATE and a migrant in, rows of _STATE out, fittest of the population first."""

    def run(batches):
        for batch in batches:
            rows = []
            for shard, island, lengths, held, migrant, first in batch[["shard", "island", "lengths", "population", "migrant", "first_bins"]].itertuples(index=False):
                work = Shard(np.asarray(lengths), capacity)
                rng = np.random.default_rng([seed, epoch, island, shard & 0xFFFFFFFF])
                if epoch == 0:
                    population = [work.first(rng, 0.0 if island == 0 else 0.02)]
                    if len(population[0]) > work.bound:
                        population += [work.first(rng, 0.05 * (k + 1)) for k in range(POPULATION - 1)]
                    first = min(map(len, population))
                else:
                    population = [_bins(np.asarray(g)) for g in held] + [_bins(np.asarray(migrant))]
                if min(map(len, population)) > work.bound:
                    population = work.evolve(population, rng)
                population = sorted(population, key=work.fitness, reverse=True)
                rows.append((shard, island, lengths, [_genome(p, len(lengths)) for p in population], len(population[0]), first, work.bound))
            yield pd.DataFrame(rows, columns=["shard", "island", "lengths", "population", "n_bins", "first_bins", "bound"])

    return run


def solve(shards: DataFrame, store: Store, capacity: int, seed: int = 3) -> DataFrame:
    """Rows (shard, elite, n_bins, first_bins, bound) for shards (shard, lengths).

    elite holds bin numbers by place, from the best island; first_bins is the
    best that best fit alone found. Shards at their bound leave the epochs.
    """
    columns = {"population": F.lit(None).cast("array<array<int>>"), "migrant": F.lit(None).cast("array<int>"), "first_bins": F.lit(0)}
    state = shards.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)]))).withColumns(columns)
    solved = None
    for epoch in range(EPOCHS):
        # An island's population travels with it: the same number of small rows each time, whatever the input.
        state = store.save(state.repartition("shard", "island").mapInPandas(lean(_island(seed, capacity, epoch)), _STATE))
        best = state.groupBy("shard").agg(
            F.min_by(F.get("population", F.lit(0)), F.struct("n_bins", "island")).alias("elite"),
            F.min("n_bins").alias("n_bins"),
            F.min("first_bins").alias("first_bins"),
            F.min("bound").alias("bound"),
        )
        best = store.save(best)
        done = best if epoch == EPOCHS - 1 else best.filter("n_bins <= bound")
        solved = done if solved is None else solved.unionByName(done)
        open_ = best.filter("n_bins > bound").select("shard")
        if epoch == EPOCHS - 1 or open_.isEmpty():
            break
        # The elite of each island goes to the next one.
        moved = state.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.get("population", F.lit(0)).alias("migrant"))
        state = state.join(open_, "shard", "left_semi").join(moved, ["shard", "island"])
    return solved


def _explained(capacity: int, least: int):
    """Rows (uid, length, sequence_id, offset, settled) of solved shards; least is the smallest piece about."""

    def run(batches):
        for batch in batches:
            for uids, lengths, elite, bound in zip(batch["uids"], batch["lengths"], batch["elite"], batch["bound"]):
                uids, lengths, genome = np.asarray(uids), np.asarray(lengths, np.int64), np.asarray(elite)
                order = np.argsort(genome, kind="stable")
                sizes = lengths[order]
                first = np.concatenate(([True], np.diff(genome[order]) != 0))
                ends = np.cumsum(sizes)
                begin = np.flatnonzero(first)
                which = np.cumsum(first) - 1
                offset = ends - sizes - (ends - sizes)[begin][which]
                fill = np.add.reduceat(sizes, begin)
                settled = (capacity - fill <= SLACK) | (capacity - fill < least)
                if len(begin) <= bound:
                    settled |= np.arange(len(begin)) != np.argmin(fill)
                yield pd.DataFrame({"uid": uids[order], "length": sizes, "sequence_id": uids[order][begin][which], "offset": offset, "settled": settled[which]})

    return run


def deal(items: DataFrame, n: int, level: int) -> DataFrame:
    """Rows (shard, uids, lengths) that deal n items (uid, length) into shards of SHARD at most."""
    count = 1 if n <= SHARD else -(-n // int(SHARD * DEALT))
    shard: Column = F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(count)) if count > 1 else F.lit(0).cast("long")
    members = F.sort_array(F.collect_list(F.struct("uid", F.col("length").cast("int").alias("length"))))
    shards = items.groupBy(shard.alias("shard")).agg(members.alias("m"))
    return shards.select("shard", F.col("m.uid").alias("uids"), F.col("m.length").alias("lengths"))


def assign(items: DataFrame, store: Store, capacity: int = CAPACITY, seed: int = 3) -> DataFrame:
    """Rows (uid, sequence_id, offset) for items (uid, length), all below the capacity."""
    done, level = None, 0
    items = items.select("uid", "length")
    while True:
        n, least = items.agg(F.count(F.lit(1)), F.min("length")).first()
        shards = store.save(deal(items, n, level))
        solved = solve(shards.select("shard", "lengths"), store, capacity, seed + level)
        rows = shards.join(solved.select("shard", "elite", "bound"), "shard").select("uids", "lengths", "elite", "bound")
        rows = store.save(rows.mapInPandas(lean(_explained(capacity, least or 0)), "uid long, length long, sequence_id long, offset long, settled boolean"))
        left = rows.filter("NOT settled").count()
        last = n <= SHARD or left == 0 or 4 * (n - left) < n
        some = (rows if last else rows.filter("settled")).select("uid", "sequence_id", "offset")
        done = some if done is None else done.unionByName(some)
        if last:
            return done
        items, level = rows.filter("NOT settled").select("uid", "length"), level + 1


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, seed: int = 3) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one per piece."""
    store = Store(docs.sparkSession, "pack")
    rows = store.save(pieces(docs, tokenizer_file, capacity))
    placed = assign(rows.filter(F.col("length") < capacity), store, capacity, seed)
    whole = rows.filter(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return rows.join(placed.unionByName(whole), "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
