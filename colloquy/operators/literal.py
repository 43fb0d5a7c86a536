"""A positional trigram index: literal search that reads a few postings and the texts that may hold the query.

Texts are dealt into parts of PART consecutive ones. For each part and each run
of three characters of its lower-cased texts a posting lists where it occurs, as
steps of two or four bytes through the part's texts put end to end; one more row
of a part says where its texts start. Postings lie sorted by gram, so that row-group statistics leave
out all but those asked for, and a gram that is very common is many rows, one for
each part. A query takes the rarest of its grams, keeps the places where they
stand at their distances from one another, and the texts of these places are
then searched for the whole query: grams propose, the text decides. Queries of
fewer than three characters are searched for in all texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contains_literal
from ..sources import scratch

#: Texts of a part and their characters at most, grams of a query that are looked up, and parts whose numbers are put into a filter.
PART, CHARS, RAREST, LISTED = 256, 1 << 20, 3, 1000
#: Bytes of a row group: what a reader can leave out.
GROUP = 1 << 20
_POSTING = "gram long, part long, places binary, n long"
#: What stands for a gram in the row of a part's starts.
STARTS = -1


def _codes(text: str) -> np.ndarray:
    """The trigrams of a text, in order, as numbers: 21 bits for each character."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return c[:-2] << 42 | c[1:-1] << 21 | c[2:] if len(c) > 2 else np.zeros(0, np.int64)


def _numbered(files: DataFrame) -> DataFrame:
    """files with part and place, the number of a text and its place in its part; rows of a task are numbered as they come."""

    def run(batches):
        part, place, chars = None, 0, 0
        for batch in batches:
            sizes, firsts = batch["_chars"].to_numpy(), batch["_n"].to_numpy()
            parts, places = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for i, (size, n) in enumerate(zip(sizes.tolist(), firsts.tolist())):
                if part is None or place >= PART or chars + size > CHARS:
                    part, place, chars = n, 0, 0
                parts[i], places[i] = part, place
                place, chars = place + 1, chars + size
            yield pd.DataFrame({"_row": batch["_row"], "part": parts, "place": places})

    row = F.struct(*[F.col(f"`{c}`") for c in files.columns]).alias("_row")
    size = F.coalesce(F.length("document"), F.lit(0)).cast("long").alias("_chars")
    numbered = files.select(row, size, F.monotonically_increasing_id().alias("_n"))
    schema = files.select(row).schema.add("part", "long").add("place", "long")
    return numbered.mapInPandas(run, schema).select("_row.*", "part", "place")


def _steps(places: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Ascending places of each group, which begin at first, as steps from one to the next; two bytes each where they are all short."""
    if not len(first):
        return []
    step = np.diff(places, prepend=0)
    step[first] = places[first]
    wide = np.maximum.reduceat(step, first) > 0xFFFF
    two, four = memoryview(step.astype("<u2").tobytes()), memoryview(step.astype("<u4").tobytes())
    ends = np.append(first[1:], len(places))
    return [bytes(four[4 * a : 4 * b]) if w else bytes(two[2 * a : 2 * b]) for a, b, w in zip(first.tolist(), ends.tolist(), wide.tolist())]


def _places(steps: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, "<u2" if len(steps) == 2 * n else "<u4"), dtype=np.int64)


def _postings(texts: DataFrame) -> DataFrame:
    """(gram, part, places, n) of texts (part, place, low)."""

    def of_part(part: int, rows: list[tuple[int, str]]) -> pd.DataFrame:
        # Texts without a row here, such as null ones, take no room.
        starts = np.zeros(rows[-1][0] + 2, np.int64)
        for place, low in rows:
            starts[place + 1] = len(low)
        starts = np.cumsum(starts)
        grams = [_codes(low) for _, low in rows]
        places = np.concatenate([starts[place] + np.arange(len(g)) for (place, _), g in zip(rows, grams)])
        grams = np.concatenate(grams)
        by = np.argsort(grams, kind="stable")
        grams, places = grams[by], places[by]
        first = np.flatnonzero(np.diff(grams, prepend=STARTS))
        size = np.diff(np.append(first, len(grams)))
        steps = _steps(starts, np.zeros(1, np.int64)) + _steps(places, first)
        return pd.DataFrame({"gram": np.append(STARTS, grams[first]), "part": part, "places": steps, "n": np.append(len(starts), size)})

    def run(batches):
        part, rows = None, []
        for batch in batches:
            for p, place, low in zip(batch["part"].tolist(), batch["place"].tolist(), batch["low"]):
                if p != part and rows:
                    yield of_part(part, rows)
                    rows = []
                part = p
                rows.append((place, low))
        if rows:
            yield of_part(part, rows)

    return texts.mapInPandas(run, _POSTING)


def _texts_at(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The numbers of the texts in which places of a part lie."""
    return np.unique(np.searchsorted(starts, places[places >= 0], side="right") - 1)


class LiteralIndex:
    """Texts (source, category, document) and their postings under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, files: DataFrame) -> "LiteralIndex":
        _numbered(files).write.option("parquet.block.size", GROUP).mode("overwrite").parquet(f"{self.path}/texts")
        texts = self.texts().select("part", "place", F.lower("document").alias("low")).filter("low IS NOT NULL")
        # A part lies in one task's output, as it was numbered there; files are read whole and in order.
        dealt = texts.repartition("part").sortWithinPartitions("part", "place")
        keys = ["gram", "part"]
        _postings(dealt).repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("parquet.block.size", GROUP).mode("overwrite").parquet(f"{self.path}/postings")
        sums = self.postings().filter(F.col("gram") != STARTS).groupBy("gram").agg(F.sum("n").alias("n"))
        sums.repartitionByRange("gram").sortWithinPartitions("gram").write.option("parquet.block.size", GROUP).mode("overwrite").parquet(f"{self.path}/grams")
        return self

    def texts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/texts")

    def postings(self) -> DataFrame:
        return self.spark.read.schema(_POSTING).parquet(f"{self.path}/postings")

    def grams(self) -> DataFrame:
        return self.spark.read.schema("gram long, n long").parquet(f"{self.path}/grams")

    def rarest(self, query: str) -> list[tuple[int, int]] | None:
        """(gram, place in the query) of the rarest grams of a lower-cased query; None if one of its grams is nowhere."""
        own = {}
        for at, gram in enumerate(_codes(query).tolist()):
            own.setdefault(gram, at)
        known = {r.gram: r.n for r in self.grams().filter(F.col("gram").isin(list(own))).collect()}
        if len(known) < len(own):
            return None
        return sorted(own.items(), key=lambda g: (known[g[0]], g[1]))[:RAREST]

    def candidates(self, query: str) -> DataFrame:
        """(part, place) of the texts in which the query's rarest grams stand as they do in the query."""
        chosen = self.rarest(query)
        if chosen is None:
            return self.spark.createDataFrame([], "part long, place long")
        offsets = dict(chosen)
        rows = self.postings().filter(F.col("gram").isin([STARTS, *offsets])).select("gram", "part", "places", "n")

        def meet(key: tuple, postings: pd.DataFrame) -> pd.DataFrame:
            starts, common = None, None
            for gram, steps, n in zip(postings["gram"].tolist(), postings["places"], postings["n"].tolist()):
                if gram == STARTS:
                    starts = _places(steps, n)
                    continue
                start = _places(steps, n) - offsets[gram]
                common = start if common is None else np.intersect1d(common, start, assume_unique=True)
            return pd.DataFrame({"part": key[0], "place": _texts_at(common, starts) if len(postings) == len(offsets) + 1 else np.zeros(0, np.int64)})

        return rows.groupBy("part").applyInPandas(meet, "part long, place long")

    def search(self, query: str) -> DataFrame:
        """Texts (source, category, document) that hold the query, case aside."""
        low = self.spark.range(1).select(F.lower(F.lit(query))).first()[0]
        columns = [c for c in self.texts().columns if c not in ("part", "place")]
        if len(low) < 3:
            return self.texts().filter(contains_literal(F.col("document"), query)).select(*columns)
        at = scratch.folder(self.spark, "candidates")
        self.candidates(low).write.parquet(at)
        found = self.spark.read.schema("part long, place long").parquet(at)
        texts = self.texts()
        parts = [r[0] for r in found.select("part").distinct().limit(LISTED + 1).collect()]
        if len(parts) <= LISTED:
            texts = texts.filter(F.col("part").isin(parts))
        return texts.join(found, ["part", "place"], "left_semi").filter(contains_literal(F.col("document"), query)).select(*columns)

    def search_many(self, queries: DataFrame) -> DataFrame:
        """(query_id, source) for queries (query_id, literal): every text that holds each; blank literals have none."""
        asked = queries.select("query_id", F.lower("literal").alias("low")).filter("low <> ''")
        short = asked.filter(F.length("low") < 3)

        def split(batches):
            for batch in batches:
                ids, grams, offsets = [], [], []
                for i, low in enumerate(batch["low"]):
                    own = {}
                    for at, gram in enumerate(_codes(low).tolist()):
                        own.setdefault(gram, at)
                    ids += [i] * len(own)
                    grams += own.keys()
                    offsets += own.values()
                out = batch.iloc[ids].reset_index(drop=True)
                out["gram"], out["offset"] = grams, offsets
                yield out

        long = asked.filter(F.length("low") >= 3)
        # Equal literals are looked up once.
        texts = long.select("low").distinct()
        split_ = texts.mapInPandas(split, "low string, gram long, offset long").join(self.grams(), "gram", "left")
        listed = split_.groupBy("low").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "gram"))).alias("gs"))
        chosen = listed.filter(F.col("gs")[0]["n"] > 0).select("low", F.least(F.size("gs"), F.lit(RAREST)).alias("take"), F.explode(F.slice("gs", 1, RAREST)).alias("g")).select("low", "take", "g.gram", "g.offset")
        met = chosen.join(self.postings(), "gram").select("low", "take", "part", "offset", "places", "n")
        begun = self.postings().filter(F.col("gram") == STARTS).select("part", F.col("places").alias("starts"), F.col("n").alias("texts"))

        def meet(key: tuple, postings: pd.DataFrame) -> pd.DataFrame:
            common = None
            for offset, steps, n in zip(postings["offset"].tolist(), postings["places"], postings["n"].tolist()):
                start = _places(steps, n) - offset
                common = start if common is None else np.intersect1d(common, start, assume_unique=True)
            common = common[common >= 0] if len(postings) == postings["take"].iloc[0] else common[:0]
            return pd.DataFrame({"low": key[0], "part": key[1], "at": [_steps(common, np.zeros(1, np.int64))[0]] if len(common) else None, "n": len(common)}, index=[0])

        def placed(batches):
            for batch in batches:
                found = [_texts_at(_places(at, n), _places(starts, texts)) for at, n, starts, texts in zip(batch["at"], batch["n"], batch["starts"], batch["texts"])]
                out = batch[["low", "part"]].iloc[np.repeat(np.arange(len(batch)), [len(f) for f in found])].reset_index(drop=True)
                out["place"] = np.concatenate(found) if found else np.zeros(0, np.int64)
                yield out

        found = met.groupBy("low", "part").applyInPandas(meet, "low string, part long, at binary, n long").filter("n > 0")
        found = found.join(begun, "part").mapInPandas(placed, "low string, part long, place long")
        low = F.lower("document")
        held = found.join(self.texts().select("part", "place", "source", low.alias("text")), ["part", "place"]).filter(F.contains("text", "low")).select("low", "source")
        every = held.join(long, "low").select("query_id", "source")
        scanned = self.texts().select("source", low.alias("text")).join(short, F.contains("text", "low")).select("query_id", "source")
        return every.unionByName(scanned)
