"""Structured Streaming: landed documents and captions into the index, and live cues into segments."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.text import normalize_patterns, normalize_whitespace, replace_terms
from ..functions.vectors import hashed_embedding
from ..operators.index import Embed, index_transcripts
from ..operators.segment import consolidate, merge_fragments, sentences_strict
from ..sources import readers, versions


def documents(spark: SparkSession, path: str, schema: str = "doc_id long, text string") -> DataFrame:
    """A stream of documents as Parquet files land in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def normalized(docs: DataFrame) -> DataFrame:
    """Cleaned sentences of each document; row by row, so it streams."""
    clean = normalize_patterns(normalize_whitespace(F.col("text")))
    return docs.withColumn("sentences", merge_fragments(sentences_strict(clean)))


def run_increment(stream: DataFrame, step: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch through step into a folder of its own under target.

    The checkpoint takes the place of a tracker: files that were processed are
    not read again, and a batch that is replayed replaces its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Buckets of the tables that a stream keeps.
BUCKETS = 64


def index_captions(
    spark: SparkSession, folder: str, cues: str, index: str, checkpoint: str, embed: Embed = hashed_embedding, replacements: dict[str, str] | None = None, max_window: float = 90.0, min_words: int = 1
) -> StreamingQuery:
    """Caption files, as they land in a folder, into an index: sliced, normalized, chunked and aligned, in one checkpointed query.

    The state is a versioned table of cues, keyed by source and times. A batch
    puts its cues in, takes all cues of the sources that it touches from the
    buckets that hold them, and replaces these sources' rows of the index. Both
    changes are upserts, so a batch that is replayed changes nothing, a late cue
    goes to its place, one that comes again with other words replaces the first,
    and no tracker is needed.
    """
    place = lambda: F.pmod(F.xxhash64("source"), F.lit(BUCKETS))

    def take(batch: DataFrame, number: int) -> None:
        said = batch.withColumn("id", F.sha2(F.to_json(F.struct("source", "start", "end")), 256)).persist()
        try:
            if said.isEmpty():
                return
            held = versions.VersionedTable(spark, cues)
            versions.upsert(held, said.select("id", "source", "start", "end", "text"), place())
            touched = said.select("source", place().alias("bucket")).distinct()
            buckets = [r[0] for r in touched.select("bucket").distinct().collect()]
            known = held.read(buckets).join(touched.select("source"), "source", "left_semi")
            ordered = F.sort_array(F.collect_list(F.struct("start", "end", "text")))
            docs = known.groupBy("source").agg(consolidate(ordered, max_window, min_words).alias("segments"))
            clean = replace_terms(normalize_patterns(normalize_whitespace(F.array_join(F.transform("segments", lambda s: s["text_raw"]), " "))), replacements or {})
            files = docs.select("source", F.array_join(merge_fragments(sentences_strict(clean)), "\n").alias("text"))
            pieces = docs.select("source", F.posexplode("segments").alias("segment_index", "s")).select("source", "segment_index", F.col("s.start").alias("start_time"), embed(F.col("s.text_raw")).alias("embedding"))
            rows = index_transcripts(files, pieces, embed=embed)
            versions.upsert(versions.VersionedTable(spark, index), rows, place(), scope="source")
        finally:
            said.unpersist()

    rows = readers.cue_rows(spark, folder, stream=True).select("source", "start", "end", "text")
    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


SEGMENT = "doc string, start double, end double, text_raw string"
STATE = "buffer string, start double, end double"


def _consolidator(max_window: float, min_words: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            buffer, start, end = state.get
            state.remove()
            if len(buffer.split()) >= min_words:
                yield pd.DataFrame([(key[0], start, end, buffer)], columns=["doc", "start", "end", "text_raw"])
            return
        buffer, start, end = state.get if state.exists else ("", None, None)
        out = []
        for batch in batches:
            for cue in batch.sort_values(["start", "end"]).itertuples():
                said = " ".join(cue.text.split())
                start, end = cue.start if start is None else start, cue.end
                buffer = f"{buffer} {said}".strip()
                ends = said.rstrip("'\"").endswith((".", "!", "?")) or end - start >= max_window
                if ends and buffer and len(buffer.split()) >= min_words:
                    out.append((key[0], round(start, 3), round(end, 3), buffer))
                    buffer, start, end = "", None, None
        if start is None:
            if state.exists:
                state.remove()
        else:
            state.update((buffer, start, end))
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), 0) + int(max_window * 1000) + 1)
        yield pd.DataFrame(out, columns=["doc", "start", "end", "text_raw"])

    return step


def live_segments(cues: DataFrame, max_window: float = 90.0, min_words: int = 1, late: str = "2 minutes") -> DataFrame:
    """Segments of a stream of cues (doc, at timestamp, start, end, text), with open ones kept as state per document."""
    watched = cues.withWatermark("at", late)
    return watched.groupBy("doc").applyInPandasWithState(_consolidator(max_window, min_words), SEGMENT, STATE, "append", "EventTimeTimeout")


def event_counts(events: DataFrame, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) in windows, with late data within a watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
