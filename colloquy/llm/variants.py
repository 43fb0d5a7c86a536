"""Spelling variants: words that differ by one letter, grouped under the commoner form.

Two words of the same length are near if they agree without the letter at one
place; a word is near a longer one if that loses one letter to give it. So every
word has keys: its text without one place (and the place), its text without one
letter, and its own text. Keys are 64-bit numbers, put together from polynomial
hashes of the prefix before and the suffix behind the letter, for all letters of
a batch of words at once in numpy. Keys go to partitions by their leading bits
and are sorted there; those that occur once drop out, and the rest are grouped
anew by the text that is left, so a collision of hashes links nothing.

Within such a group nothing is paired: a count and the two commonest words tell
each member how many others it is near and which is the commonest. A group
without a place holds one letter's alternatives, at most as many words as there
are letters.

A word's form at least doubles its count, so the way from a word to its root is
short; it is followed by doubling pointers.

Edge cases: null and empty texts have no words; a null id is written as nothing
where the query plants errors; repeated rows count each; other columns are
ignored; an empty table gives an empty result. Very long texts are read in
slices, very long words have as many keys as letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columns import lean
from .store import Store

#: Letters, and the capitals that are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_runs = re.compile(f"[{LETTERS}]+").findall
_gap = re.compile(f"[^{LETTERS}]").search
#: Letters of distinct words that a task counts before it hands them on; letters of a text that are read at once.
COUNTED, SLICE = 8_000_000, 1 << 20
#: Leading bits of a key that choose its partition.
RADIX = 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def slices(text: str):
    """The text in parts that cut no run of letters."""
    at = 0
    while len(text) - at > SLICE:
        gap = _gap(text, at + SLICE)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def planted(word: str, key: str | None) -> str:
    """The word, without one letter in one document of 97."""
    h = zlib.crc32(f"{key or ''}:{word}".encode())
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, shortest: int, plant=planted) -> DataFrame:
    """(word, n): lower-cased runs of letters as plant(run, id) leaves them, and their number; rows of one word are to be added up."""

    def run(batches):
        total, size = {}, 0
        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"]):
                for part in slices(text or ""):
                    for word, n in Counter(_runs(part)).items():
                        word = plant(word.lower() if word.isascii() else word.translate(_LOWER), key)
                        if len(word) < shortest:
                            continue
                        if word in total:
                            total[word] += n
                        else:
                            total[word] = n
                            size += len(word) + 8
                if size > COUNTED:
                    yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                    total, size = {}, 0
        yield pd.DataFrame({"word": pd.Series(list(total), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(lean(run), "word string, n long")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose leading bits depend on all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def deletion_keys(words: list[str], shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, index of its word, place, kind) of all words.

    Kind 0 is a text without the letter at a place, which has to be the same;
    kind 1 is a text without one letter, or, at place -1, a whole text. Letters
    that repeat the one before them give the same text, so they are left out.
    """
    size = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = np.cumsum(size)
    start = end - size
    owner = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(letters)) - start[owner]
    longest = int(size.max(initial=0))
    powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(longest, _BASE, np.uint64)))
    # Prefix sums of letter * base^place: differences give the hash of any stretch.
    sums = np.append(np.uint64(0), np.cumsum(_mixed(letters + np.uint64(1)) * powers[place], dtype=np.uint64))
    whole = sums[end] - sums[start]
    prefix = sums[:-1] - sums[start[owner]]
    suffix = (sums[end[owner]] - sums[1:]) * np.uint64(_INVERSE)
    left = prefix + suffix
    length = size.astype(np.uint64)
    salt = np.uint64(0xD6E8FEB86659FD93)
    same = _mixed(_mixed(left + length[owner] * salt) + place.astype(np.uint64))
    shorter = np.flatnonzero((size[owner] > shortest) & ((place == 0) | (letters != np.append(np.uint64(0), letters[:-1]))))
    lost = ~_mixed(left[shorter] + (length[owner[shorter]] - np.uint64(1)) * salt)
    own = ~_mixed(whole + length * salt)
    key = np.concatenate([same, lost, own]).view(np.int64)
    index = np.concatenate([owner, owner[shorter], np.arange(len(words))])
    places = np.concatenate([place, place[shorter], np.full(len(words), -1)])
    kind = np.repeat(np.array([0, 1, 1]), [len(same), len(lost), len(own)])
    return key, index, places, kind


def _keys(words: DataFrame, shortest: int) -> DataFrame:
    """(key, id, place, kind) of words (id, word)."""

    def run(batches):
        for batch in batches:
            size = batch["word"].str.len().cumsum().to_numpy()
            cuts = np.append(0, np.flatnonzero(np.diff(size // 500_000)) + 1).tolist() + [len(batch)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.iloc[a:b]
                key, index, place, kind = deletion_keys(part["word"].tolist(), shortest)
                ids = part["id"].to_numpy()[index]
                for c in range(0, len(key), 1_000_000):
                    d = slice(c, c + 1_000_000)
                    yield pd.DataFrame({"key": key[d], "id": ids[d], "place": place[d], "kind": kind[d]})

    return words.select("id", "word").mapInPandas(lean(run), "key long, id long, place int, kind int")


def _shared(keys: DataFrame) -> DataFrame:
    """The rows whose key another row has; keys are dealt by their leading bits, sorted, and compared with the next."""

    def run(batches):
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            key = rows["key"].to_numpy()
            equal = key[1:] == key[:-1]
            meets = np.append(equal, False) | np.append(False, equal)
            # The last row waits for the next batch, and tells whether the one before it had its key.
            if held is not None:
                meets[0] |= held_met
            yield rows[:-1][meets[:-1]]
            held, held_met = rows[-1:], bool(meets[-1])
        if held is not None and held_met:
            yield held

    dealt = keys.withColumn("radix", F.shiftrightunsigned("key", 64 - RADIX)).repartition("radix").sortWithinPartitions("key")
    return dealt.drop("radix").mapInPandas(lean(run), keys.schema)


def _near(words: DataFrame, shared: DataFrame) -> DataFrame:
    """(id, n_near, best): of words with near ones, how many, and the commonest as (-n, word, id)."""
    place = F.col("place")
    text = F.when(place < 0, F.col("word")).otherwise(F.concat(F.expr("left(word, place)"), F.expr("substring(word, place + 2)")))
    rows = shared.join(words, "id").select("id", "kind", F.when(F.col("kind") == 0, place).otherwise(-1).alias("at"), (place < 0).alias("own"), text.alias("rest"), F.struct((-F.col("n")).alias("n"), "word", "id").alias("said"))
    group = Window.partitionBy("rest", "at", "kind")
    ranked = rows.withColumn("rank", F.row_number().over(group.orderBy("own", "said")))
    others = F.count(F.when(~F.col("own"), 1)).over(group)
    first, second = (F.max(F.when((F.col("rank") == k) & ~F.col("own"), F.col("said"))).over(group) for k in (1, 2))
    short = F.max(F.when(F.col("own"), F.col("said"))).over(group)
    told = ranked.select("id", "kind", "own", "rank", others.alias("others"), first.alias("first"), second.alias("second"), short.alias("short"))
    same, inside = F.col("kind") == 0, ~F.col("own")
    near = F.when(same, F.col("others") - 1).when(inside, F.col("short").isNotNull().cast("long")).otherwise(F.col("others"))
    best = F.when(same, F.when(F.col("rank") == 1, F.col("second")).otherwise(F.col("first"))).when(inside, F.col("short")).otherwise(F.col("first"))
    found = told.select("id", near.alias("near"), best.alias("best")).filter("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame, store: Store) -> DataFrame:
    """(id, root): where the pointers (id, root) lead at last; each round doubles their reach."""
    now = store.save(forms)
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        moved = store.save(now.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
        store.free(now)
        now = moved


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, times: int = 2, plant=planted) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words have at least `shortest` letters (two or more) and `least` occurrences. A word's form
    is the commonest word that differs from it by one letter, the first in
    code-point order among equals, if it is `times` as common or more.
    """
    store = Store(docs.sparkSession, "variants")
    counts = count_words(docs, shortest, plant).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = store.save(counts.select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    shared = store.save(_shared(_keys(words, shortest)))
    near = store.save(_near(words, shared))
    named = words.join(near, "id", "left")
    common = -F.col("best.n") >= times * F.col("n")
    pointers = named.filter(common).select("id", F.col("best.id").alias("root"))
    roots = _roots(pointers, store)
    last = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    form, form_n = (F.when(common, value) for value in (F.col("best.word"), -F.col("best.n")))
    return named.join(last, "id", "left").select("word", form.alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form_n.alias("form_n"))
