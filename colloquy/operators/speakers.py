"""Names of known people: their variants, where they are said, and what to tell a prompt about them."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..sources import scratch

VARIANTS = "person string, variant string"


def name_variants(people: DataFrame, titles: DataFrame) -> DataFrame:
    """Rows (person, variant) from people (role, person_key, aliases) and titles (role, titles).

    A person has their aliases, first, last and full name (the key split at its
    first underscore), and these behind each title of their role.
    """
    person = strip(F.col("person_key"))
    rows = people.withColumn("person", person).filter(F.coalesce(F.col("person"), F.lit("")) != "").join(titles, "role", "left")
    first, last = F.substring_index("person", "_", 1), F.when(F.contains("person", F.lit("_")), F.regexp_replace("person", "^[^_]*_", "")).otherwise("")
    joined = lambda *parts: strip(F.array_join(F.filter(F.array(*parts), lambda p: p != ""), " "))
    first, last = strip(first), strip(last)
    full = joined(first, last)
    listed = F.filter(F.transform(F.coalesce("titles", F.array().cast("array<string>")), strip), lambda t: F.coalesce(t, F.lit("")) != "")
    titled = F.flatten(
        F.transform(
            listed,
            lambda t: F.concat(
                F.array(joined(t, last), joined(t, full)),
                F.when(F.contains(t, F.lit(" ")), F.array(joined(t, F.lit("Director"), last), joined(t, F.lit("Director"), full))).otherwise(F.array().cast("array<string>")),
            ),
        )
    )
    aliases = F.transform(F.coalesce("aliases", F.array().cast("array<string>")), strip)
    variants = F.filter(F.concat(aliases, F.array(first, last, full), titled), lambda v: F.coalesce(v, F.lit("")) != "")
    return rows.select("person", F.explode(variants).alias("variant")).distinct()


def hotwords(people: DataFrame, titles: DataFrame) -> DataFrame:
    """One row (hotwords): all titles and aliases, sorted and joined; null if there are none."""
    said = people.select(F.explode("aliases").alias("w")).unionByName(titles.select(F.explode("titles").alias("w")))
    words = said.select(strip(F.col("w")).alias("w")).filter("w <> ''")
    return words.agg(F.nullif(F.array_join(F.array_sort(F.collect_set("w")), ", "), F.lit("")).alias("hotwords"))


#: Words and what stands between them, in turn; ASCII letters are told by themselves, which is much faster than by their classes.
_TOKENS = r"(?U)[a-z0-9_\w]++|[^a-z0-9_\w]++"
_WORD = r"(?U)[a-z0-9_\w]"
#: Variants whose hashes are sent to all tasks at most: 8 bytes each. With more, all windows meet the variants in a join.
SENT = 1_000_000
_BASE = 0x9E3779B97F4A7C15


def _windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each stretch of `size` tokens, from sums of their hashes times powers of a base."""
    n = max(0, len(hashes) - size + 1)
    found = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            found = found * np.uint64(_BASE) + hashes[k : k + n]
        found = (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(size)
        return (found ^ (found >> np.uint64(32))).view(np.int64)


def _hashes(tokens: pa.Array) -> np.ndarray:
    """A hash of each token; distinct ones are hashed once."""
    coded = tokens.dictionary_encode()
    own = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False) if len(coded.dictionary) else np.zeros(0, np.uint64)
    return own[coded.indices.to_numpy(zero_copy_only=False)]


def _tokens(text: Column) -> Column:
    """A lower-cased text's tokens."""
    return F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))


def scan_names(chunks: DataFrame, variants: DataFrame, key: list[str], text: str = "text", apart: bool = False) -> DataFrame:
    """Rows (key, person, variant) of the variants said in chunks as whole words.

    Variants are grouped by their number of tokens. The windows of a batch of
    texts get hashes for each such number, and those that some variant has go on
    with their own characters, which decide; so a text is read once, and is tried
    against no variant by itself. The variants' hashes are sent to all tasks up to
    SENT of them; with more, nothing is hashed, and every window goes to the join,
    which Spark splits where a window is very common.

    apart also takes a variant whose words follow one another in a chunk whatever
    stands between them, if its text stands anywhere in it, within words too.
    """
    spark = chunks.sparkSession
    low = F.lower("variant")
    named = variants.filter(low.rlike(_WORD)).select("person", "variant", low.alias("said"))
    token = _tokens(F.col("said"))
    flat = F.array_join(F.filter(token, lambda t: t.rlike(_WORD)), " ") if apart else F.col("said")
    wanted = scratch.written(named.select("*", flat.alias("flat")).select("*", F.size(_tokens(F.col("flat"))).alias("tokens")), "variants")
    sizes = [r[0] for r in wanted.select("tokens").distinct().collect()]
    sent = None
    if wanted.count() <= SENT:

        def name(batches):
            for batch in batches:
                rows = batch.column(0)
                hashes, size = _hashes(rows.flatten()), rows.value_lengths().to_numpy()
                first = np.cumsum(size) - size
                found = [_windows(hashes, n)[first[size == n]] for n in np.unique(size).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64))], ["hash"])

        hashes = wanted.select(_tokens(F.col("flat")).alias("t")).mapInArrow(name, "hash long").distinct().collect()
        sent = spark.sparkContext.broadcast(np.array(sorted(r[0] for r in hashes), np.int64))

    def find(batches):
        for batch in batches:
            lists, word = batch["_t"].tolist(), batch["_w"].to_numpy(bool)
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            tokens = pa.array(np.concatenate(lists) if lists else [], pa.string())
            ends = np.cumsum(size)
            row = np.repeat(np.arange(len(size)), size)
            hashes = _hashes(tokens)
            # A window that begins or ends between words has to have a word beyond.
            begin = ends - size + ~word
            end = ends - ((size % 2 == 0) == word)
            places, spans = [], []
            for n in sizes:
                at = np.arange(max(0, len(hashes) - n + 1))
                at = at[(at >= begin[row[at]]) & (at + n <= end[row[at]])] if len(at) else at
                if sent is not None:
                    own = _windows(hashes, n)[at]
                    place = np.minimum(np.searchsorted(sent.value, own), len(sent.value) - 1)
                    at = at[sent.value[place] == own] if len(sent.value) else at[:0]
                places.append(at)
                spans.append(np.full(len(at), n))
            at, span = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, spans))
            said = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(span)), pa.int32()), tokens.take(pa.array(np.repeat(at, span) + _within(span))))
            said = pc.binary_join(said, "")
            # What a text says again is sent once.
            out = pa.table({"row": pa.array(row[at]), "flat": said}).group_by(["row", "flat"]).aggregate([]).combine_chunks()
            found = batch.iloc[out["row"].to_numpy()][kept].reset_index(drop=True)
            found["flat"] = out["flat"].to_pandas().astype(object)
            yield found

    body = F.lower(F.col(text))
    kept = ["_key", "_low"] if apart else ["_key"]
    read = chunks.filter(body != "").select(F.struct(*key).alias("_key"), body.alias("_low"))
    words = F.array_join(F.filter(_tokens(F.col("_low")), lambda t: t.rlike(_WORD)), " ") if apart else F.col("_low")
    read = read.select(*kept, words.alias("_s")).filter("_s <> ''")
    read = read.select(*kept, _tokens(F.col("_s")).alias("_t"), F.col("_s").rlike(r"(?U)^\w").alias("_w"))
    schema = read.select(*kept).schema.add("flat", "string")
    met = read.mapInPandas(find, schema).join(wanted, "flat")
    if apart:
        met = met.filter(F.contains("_low", "said"))
    return met.select(*[F.col("_key").getField(k).alias(k) for k in key], "person", "variant").distinct()


def _within(span: np.ndarray) -> np.ndarray:
    """0, 1, … for each span, one behind the other."""
    return np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span)


#: Variants of a gazetteer that is sent to all tasks at most.
GAZETTEER = 100_000
_NOT_WORDS, _WORDS = r"(?U)[^a-z0-9_\w]++", r"(?U)[a-z0-9_\w]++"


def _proposed(flat: pa.Array, sent: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, place in sent) of the stretches of words, for each of sizes, whose hash is in sent; each once."""
    lists = pc.split_pattern(pc.fill_null(flat, ""), " ")
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    hashes = _hashes(lists.flatten())
    row, ends = np.repeat(np.arange(len(size)), size), np.cumsum(size)
    found = []
    for n in sizes:
        own = _windows(hashes, n)
        place = np.minimum(np.searchsorted(sent, own), len(sent) - 1)
        at = np.flatnonzero(sent[place] == own)
        at = at[at + n <= ends[row[at]]]
        pairs = np.unique(row[at] * len(sent) + place[at])
        found.append(np.divmod(pairs, len(sent)))
    return found


def names_in(text: Column, variants: DataFrame, apart: bool = False) -> Column | None:
    """The persons whom a text says by their variants, distinct, sorted and joined, as scan_names finds them; null where nobody is said.

    A column, so nothing is shuffled and no text is read twice. The variants are
    sent to all tasks; None if there are more than GAZETTEER. Hashes of words in a
    row propose a variant, the text decides.
    """
    marked = lambda t: F.regexp_replace(t, _WORDS, "\0$0\0")
    flat = lambda t: F.regexp_replace(t, _NOT_WORDS, " ")
    said = F.lower("variant")
    listed = variants.filter(said.rlike(_WORD)).limit(GAZETTEER + 1).select("person", said.alias("said"), F.btrim(flat(said), F.lit(" ")).alias("flat"), marked(said).alias("marked")).collect()
    if len(listed) > GAZETTEER:
        return None
    words = pa.array([r.flat.split(" ") for r in listed], pa.list_(pa.string()))
    hashes, size = _hashes(words.flatten()), words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(size) - size
    sizes = np.unique(size).tolist()
    meant: dict[int, list] = {}
    for n in sizes:
        for k, h in zip(np.flatnonzero(size == n).tolist(), _windows(hashes, n)[first[size == n]].tolist()):
            r = listed[k]
            # A mark stands at both ends of a word, so that words and what is between them are met whole.
            whole = r.marked if r.marked[0] == "\0" else "\0" + r.marked
            sought = r.said if apart else whole if whole[-1] == "\0" else whole + "\0"
            meant.setdefault(h, []).append((f" {r.flat} ", sought, r.person))
    sent = np.array(sorted(meant), np.int64)
    meant = [meant[h] for h in sent.tolist()]
    held = variants.sparkSession.sparkContext.broadcast((sent, meant))

    @F.arrow_udf("string")
    def find(flat: pa.Array, text: pa.Array) -> pa.Array:
        sent, meant = held.value
        people: list = [None] * len(flat)
        if len(sent):
            flats, texts = flat.to_pylist(), text.to_pylist()
            for rows, places in _proposed(flat, sent, sizes):
                for i, k in zip(rows.tolist(), places.tolist()):
                    for near, whole, person in meant[k]:
                        if whole in texts[i] and near in f" {flats[i]} ":
                            people[i] = people[i] or set()
                            people[i].add(person)
        joined = [p and ", ".join(sorted((x for x in p if x is not None), key=str.encode)) for p in people]
        return pa.array(joined, pa.string())

    low = F.lower(text)
    return find(flat(low), low if apart else marked(low))


def speaker_context(matches: DataFrame, key: list[str]) -> DataFrame:
    """Rows (key, context) from rows (key, person, variant): whom a chunk mentions, and which mentions are unclear."""
    longest = lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0)
    people = matches.groupBy(*key, "person").agg(F.array_sort(F.collect_set("variant"), longest).alias("vs"))
    readable = F.replace("person", F.lit("_"), F.lit(" "))
    line = lambda vs: F.concat(F.lit("  - "), readable, F.lit(": "), F.array_join(vs, ", "))
    short = F.filter("vs", lambda v: ~v.rlike(r"(?U)\s") & ~F.contains(F.lower("person"), F.lower(v)))
    lines = F.array(F.when(F.size("vs") > 1, line(F.col("vs"))), F.when(F.size(short) > 0, line(short)))
    people = people.select(*key, "person", F.get("vs", 0).alias("best"), F.filter(lines, lambda x: x.isNotNull()).alias("lines"))
    each = people.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("person", "best", "lines"))).alias("ps"))
    unclear = F.flatten(F.transform("ps", lambda p: p["lines"]))
    # The sentences of the context.
    head = F.concat(F.lit("**Speakers detected in this segment: "), F.array_join(F.transform("ps", lambda p: p["best"]), ", "), F.lit(".**"))
    note = F.when(F.size(unclear) > 0, F.concat(F.array(F.lit("*Some mentions are ambiguous or used multiple name variants:*")), unclear)).otherwise(F.array().cast("array<string>"))
    tail = F.array(F.lit("*Mentions may refer to multiple individuals if only first names are used.*"))
    return each.select(*key, F.array_join(F.concat(F.array(head), note, tail), "\n").alias("context"))
