"""Building the search index: chunks with embeddings, metadata and times, upserted by id."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import meta
from ..functions.text import NOT_WS, WS, strip, word_count
from ..functions.vectors import CLAMP, hashed_embedding
from ..sources import scratch
from ..sources.versions import one_of_each
from .chunk import index_chunks
from .speakers import names_in, scan_names

#: A model as a function of a text column.
Embed = Callable[[Column], Column]
#: Instruction that queries, and queries only, carry into the embedding.
QUERY_PREFIX = "Represent this sentence for searching relevant passages: "
SUMMARY_CHUNKS, TRANSCRIPT_CHUNKS = (300, 50), (150, 25)
SUMMARY_PREFIX, TRANSCRIPT_PREFIX = "Meeting summary: ", "Transcript excerpt: "
MONEY = r"(?i)(\$\s?\d[\d,]*(?:\.\d+)?(?:\s?(?:million|billion|thousand))?)"


def file_metadata(files: DataFrame, category: str, id_map: DataFrame | None = None, name: str = "source") -> DataFrame:
    """Adds category, type, date, video_id and video_url, worked out from the file name.

    id_map (lower_id, real_id) restores the case of ids.
    """
    rows = files.withColumn("category", F.lit(category)).withColumn("type", meta.document_type(F.col(name))).withColumn("date", meta.file_date(F.col(name)))
    rows = rows.withColumn("_file_id", meta.file_id(F.col(name)))
    if id_map is None:
        rows = rows.withColumn("video_id", F.col("_file_id"))
    else:
        ids = id_map.select(F.col("lower_id").alias("_lower"), F.col("real_id").alias("_real"))
        rows = rows.join(ids, F.lower("_file_id") == F.col("_lower"), "left").withColumn("video_id", F.coalesce("_real", "_file_id")).drop("_lower", "_real")
    return rows.withColumn("video_url", meta.watch_url(F.col("video_id"))).drop("_file_id")


def amounts(text: Column) -> Column:
    """Amounts of money as an array."""
    return F.regexp_extract_all(text, F.lit(MONEY), 1)


def entities(text: Column, find: Embed = amounts) -> Column:
    """What find returns of a text as an array, distinct, sorted and joined; null for short texts and where there is nothing."""
    found = F.array_join(F.array_sort(F.array_distinct(find(text))), ", ")
    return F.when(word_count(text) > 10, F.nullif(found, F.lit("")))


def _chunks(files: DataFrame, size: int, overlap: int) -> DataFrame:
    rows = files.select(*[c for c in files.columns if c != "text"], F.posexplode(index_chunks(F.col("text"), size, overlap)).alias("chunk_index", "chunk"))
    return rows.filter(strip(F.col("chunk")) != "")


def index_summaries(files: DataFrame, id_map: DataFrame | None = None, embed: Embed = hashed_embedding, size: int = 300, overlap: int = 50, prefix: str = SUMMARY_PREFIX) -> DataFrame:
    """Index rows of summary files (source, text); the prefix is part of what is embedded."""
    rows = _chunks(file_metadata(files, "summary", id_map), size, overlap).withColumn("document", F.concat(F.lit(prefix), F.col("chunk")))
    identity = F.concat_ws("_", F.lit("SUMMARY"), "source", F.col("chunk_index").cast("string"))
    none = F.lit(None)
    return rows.select(identity.alias("id"), "document", embed(F.col("document")).alias("embedding"), "source", "category", "type", "date", "video_url", "video_id", "chunk_index", none.cast("double").alias("ts"), none.cast("string").alias("money"))


#: Chunks and segments of a cell: one task compares so many with each other at a time.
CELL = 2048


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of length one, as cosine() takes them; shorter and null ones end in zeros."""
    vectors = vectors.combine_chunks()
    size = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    m = np.zeros((len(size), int(size.max(initial=0))))
    m[np.arange(m.shape[1]) < size[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return m / np.maximum(np.sqrt((m * m).sum(axis=1, keepdims=True)), CLAMP)


def _starts(rows: pa.Table) -> np.ndarray:
    """Where runs of rows of one document and one pair of cells begin."""
    differ = np.zeros(max(0, len(rows) - 1), bool)
    for values in (rows[name].to_numpy() for name in ("_g", "_a", "_b")):
        differ |= values[1:] != values[:-1]
    name = rows["_k"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    differ |= name[1:] != name[:-1]
    return np.append(0, np.flatnonzero(differ) + 1)


def align(chunks: DataFrame, segments: DataFrame, key: str, chunk: str = "chunk_index", cell: int = CELL) -> DataFrame:
    """Rows (key, chunk, ts): the start of the segment most similar to each chunk of the same document.

    chunks: (key, chunk, embedding); segments: (key, segment_index, start_time,
    embedding). The lowest segment wins a tie, to nine decimals. Both sides are
    dealt into cells by their numbers; a pair of cells of one document is one
    matrix product, of which each chunk's best stays, so a document of any length
    is many tasks' work and no pair of vectors is a row.
    """
    spark_cells = lambda rows, name: rows.groupBy(F.col(key).alias("_k")).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(cell))).cast("long").alias(name))
    cells = spark_cells(chunks, "_down").join(spark_cells(segments, "_across"), "_k")
    # Single precision stays as it is until it is compared: half the bytes of a vector.
    held = "array<float>" if all(t.schema["embedding"].dataType.simpleString() == "array<float>" for t in (chunks, segments)) else "array<double>"
    vector = F.col("embedding").cast(held)
    mine = chunks.select(F.col(key).alias("_k"), F.lit(0).alias("_side"), F.col(chunk).cast("long").alias("_i"), F.lit(None).cast("double").alias("_at"), vector.alias("_v"))
    theirs = segments.select(F.col(key).alias("_k"), F.lit(1).alias("_side"), F.col("segment_index").cast("long").alias("_i"), F.col("start_time").cast("double").alias("_at"), vector.alias("_v"))
    down, across = F.pmod(F.xxhash64("_i"), F.col("_down")), F.pmod(F.xxhash64("_i"), F.col("_across"))
    other = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    mine = mine.join(cells, "_k").withColumn("_a", down).withColumn("_b", other(F.col("_across")))
    theirs = theirs.join(cells, "_k").withColumn("_b", across).withColumn("_a", other(F.col("_down")))
    names = ["_k", "_a", "_b", "_side", "_i", "_at", "_v"]
    dealt = mine.select(*names).unionByName(theirs.select(*names)).withColumn("_g", F.xxhash64("_k", "_a", "_b"))
    dealt = dealt.repartition("_g").sortWithinPartitions("_g", "_k", "_a", "_b", "_side", "_i")

    def best(rows: pa.Table) -> pa.RecordBatch:
        """The best segment of each chunk in rows of whole groups; groups are runs of rows, vectors become one matrix."""
        side, number, at = rows["_side"].to_numpy(), rows["_i"].to_numpy(), rows["_at"].to_numpy()
        first = np.append(_starts(rows), len(rows))
        m = _matrix(rows["_v"])
        chunk, seg, near = [], [], []
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            split = lo + int((side[lo:hi] == 0).sum())
            if lo < split < hi:
                for a in range(lo, split, 256):
                    sims = np.round(m[a : min(split, a + 256)] @ m[split:hi].T, 9)
                    top = sims.argmax(axis=1)  # the first, and segments are in order
                    chunk.append(np.arange(a, a + len(top)))
                    seg.append(split + top)
                    near.append(sims[np.arange(len(top)), top])
        chunk, seg = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (chunk, seg))
        names = rows["_k"].combine_chunks().take(pa.array(chunk))
        return pa.RecordBatch.from_arrays([names, pa.array(number[chunk]), pa.array(np.concatenate(near) if near else np.zeros(0)), pa.array(number[seg]), pa.array(at[seg])], ["_k", "_i", "sim", "seg", "at"])

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            # The last group may go on in the next batch.
            cut = int(_starts(rows)[-1]) if len(rows) else 0
            if cut:
                yield best(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None and len(held):
            yield best(held)

    schema = dealt.select("_k", "_i").schema.add("sim", "double").add("seg", "long").add("at", "double")
    met = dealt.mapInArrow(run, schema)
    order = F.struct(F.col("sim"), -F.col("seg"))
    found = met.groupBy("_k", "_i").agg(F.max_by("at", order).alias("ts"))
    return found.select(F.col("_k").alias(key), F.col("_i").cast(chunks.schema[chunk].dataType).alias(chunk), "ts")


def with_names(chunks: DataFrame, name: str, variants: DataFrame, apart: bool = False) -> DataFrame:
    """Adds a column of those of a gazetteer (person, variant) whom a chunk says, distinct, sorted and joined; null where nobody is said.

    apart is that of scan_names. A gazetteer too large to be sent meets the chunks in a join.
    """
    # More than ten words, of which no more are looked at.
    long = F.col("chunk").rlike(rf"(?U)^(?:{WS}*+{NOT_WS}++){{11}}")
    found = names_in(F.col("chunk"), variants, apart)
    if found is not None:
        return chunks.withColumn(name, F.when(long, found))
    said = scan_names(chunks.filter(long).select("source", "chunk_index", "chunk"), variants, ["source", "chunk_index"], "chunk", apart)
    listed = said.groupBy("source", "chunk_index").agg(F.array_join(F.array_sort(F.collect_set("person")), ", ").alias(name))
    return chunks.join(listed, ["source", "chunk_index"], "left")


def index_transcripts(
    files: DataFrame,
    segments: DataFrame | None = None,
    id_map: DataFrame | None = None,
    embed: Embed = hashed_embedding,
    size: int = 150,
    overlap: int = 25,
    prefix: str = TRANSCRIPT_PREFIX,
    finders: dict[str, Embed] | None = None,
    names: dict[str, DataFrame] | None = None,
    apart: bool = False,
) -> DataFrame:
    """Index rows of transcript files (source, text); the prefix is shown but not embedded.

    Chunks get the time of the nearest of their document's segments (source,
    segment_index, start_time, embedding); null without segments. finders name
    further columns of entities, such as orgs and persons, and the functions of
    the chunk that find them, which may be pandas UDFs around a model. names
    names columns, such as persons and orgs, and their gazetteers (person,
    variant): whom a chunk of more than ten words says by one of the variants;
    apart is that of scan_names.
    """
    found = [entities(F.col("chunk"), find).alias(name) for name, find in ({"money": amounts} | (finders or {})).items()]
    rows = _chunks(file_metadata(files, "raw_transcript", id_map), size, overlap).withColumn("embedding", embed(F.col("chunk")))
    if segments is None:
        rows = rows.withColumn("ts", F.lit(None).cast("double"))
    else:
        # Both sides are read several times; texts are cut and embedded once.
        rows, segments = scratch.written(rows, "chunks"), scratch.written(segments, "said")
        rows = rows.join(align(rows, segments, "source"), ["source", "chunk_index"], "left")
    for name, variants in (names or {}).items():
        rows = with_names(rows, name, variants, apart)
        found.append(F.col(name))
    identity = F.concat_ws("_", F.lit("TRANSCRIPT"), "source", F.col("chunk_index").cast("string"))
    return rows.select(identity.alias("id"), F.concat(F.lit(prefix), F.col("chunk")).alias("document"), "embedding", "source", "category", "type", "date", "video_url", "video_id", "chunk_index", "ts", *found)


def with_summary_flag(transcripts: DataFrame, summaries: DataFrame, name: str = "source") -> DataFrame:
    """Adds has_summary: whether a transcript's summary file (name) is there."""
    known = summaries.select(F.col(name).alias("_summary")).distinct().withColumn("_there", F.lit(True))
    rows = transcripts.withColumn("_summary", meta.summary_name(F.col(name))).join(known, "_summary", "left")
    return rows.withColumn("has_summary", F.coalesce("_there", F.lit(False))).drop("_summary", "_there")


def embed_query(query: Column, embed: Embed = hashed_embedding) -> Column:
    """The vector of a query, which carries its instruction into the embedding."""
    return embed(F.concat(F.lit(QUERY_PREFIX), query))


def upsert(old: DataFrame, new: DataFrame, key: str = "id", order: list[str] = ()) -> DataFrame:
    """old with rows of new put in by key; of several new rows with a key the one with the largest order, then the largest hash, stays."""
    fresh = one_of_each(new, key, order)
    return old.join(fresh.select(key), key, "left_anti").unionByName(fresh)
