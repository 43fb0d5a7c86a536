"""DataFrames as files, and the texts that go into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_path_part, strip
from ..operators.segment import vtt_stamp


def vtt_text(segments: Column) -> Column:
    """A WebVTT file's text from array<struct<start,end,text>>, in order of start."""
    ordered = F.array_sort(segments, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    cues = F.transform(ordered, lambda s: F.concat(vtt_stamp(s["start"]), F.lit(" --> "), vtt_stamp(s["end"]), F.lit("\n"), strip(s["text"]), F.lit("\n")))
    return F.concat(F.lit("WEBVTT\n\n"), F.array_join(cues, "\n"))


def segment_text(segments: Column) -> Column:
    """Segments one under another with blank lines between."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["text_raw"], F.lit("\n\n"))), "")


def sentence_lines(sentences: Column) -> Column:
    """A normalized transcript: one sentence on a line, with a line break at the end."""
    kept = F.filter(F.transform(sentences, lambda s: F.trim(s)), lambda s: s != "")
    # Read once, so that the plan doesn't work the sentences out twice.
    return F.array_join(F.transform(kept, lambda s: F.concat(s, F.lit("\n"))), "")


def summary_text(name: Column, summary: Column, form: str = "markdown") -> Column:
    """A summary as Markdown under a title, or as YAML."""
    if form == "markdown":
        return F.concat(F.lit("# Summary: "), name, F.lit("\n\n"), strip(summary), F.lit("\n"))
    if form == "yaml":
        return F.concat(F.lit("summary: |-\n  "), F.regexp_replace(strip(summary), "\n", "\n  "), F.lit("\n"))
    raise ValueError(f"unknown summary format: {form}")


def write_texts(rows: DataFrame, path: str, name: str = "source", text: str = "text") -> None:
    """One folder per document, each with its text; the file ends in one line break at least."""
    body = F.regexp_replace(F.col(text), r"\n\z", "")
    rows.select(safe_path_part(F.col(name)).alias("document"), body.alias("value")).write.partitionBy("document").mode("overwrite").text(path)


def write_segments(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_chunks(rows: DataFrame, path: str) -> None:
    """Chunks (doc, meeting_type, pass, part, chunk) in folders by document, type and pass, each under its name; parts count from 0, names from 1."""
    safe = rows.withColumn("doc", safe_path_part(F.col("doc"))).withColumn("meeting_type", safe_path_part(F.col("meeting_type")))
    named = safe.withColumn("file", F.format_string("%s_part%02d.txt", "doc", F.col("part") + 1))
    named.write.partitionBy("doc", "meeting_type", "pass").mode("overwrite").json(path)


def write_chunk_texts(rows: DataFrame, path: str) -> None:
    """Chunks (doc, meeting_type, pass, part, chunk) as texts: a folder for each, named <doc>_partNN.txt, below its type and pass."""
    name = F.format_string("%s_part%02d.txt", safe_path_part(F.col("doc")), F.col("part") + 1)
    rows.select(safe_path_part(F.col("meeting_type")).alias("meeting_type"), "pass", name.alias("file"), F.col("chunk").alias("value")).write.partitionBy("meeting_type", "pass", "file").mode("overwrite").text(path)


def append_tracker(keys: DataFrame, path: str, key: str = "key") -> None:
    keys.select(F.col(key).cast("string").alias("value")).distinct().write.mode("append").text(path)


def write_listing(rows: DataFrame, path: str) -> None:
    rows.select("fetched_at", "channel", "video_ids").write.mode("overwrite").json(path)
