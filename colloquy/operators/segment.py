"""Cues, sentences and segments of one document, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LINE_BREAK, WS, clean_lines, let, strip, words

#: Where a sentence ends, for loose splitting.
SENTENCE_END = rf"(?U){WS}(?<=[.?!]{WS}){WS}*+"
SEGMENT = "struct<start:double,end:double,text_raw:string>"


def vtt_seconds(stamp: Column) -> Column:
    """Seconds of [HH:]MM:SS.mmm; an error otherwise."""
    parts = F.split(F.replace(F.trim(stamp), F.lit(","), F.lit(".")), ":")
    n = lambda i: F.get(parts, i).cast("double")
    fault = F.raise_error(F.concat(F.lit("not a timestamp: "), stamp)).cast("double")
    return F.when(F.size(parts) == 3, n(0) * 3600 + n(1) * 60 + n(2)).when(F.size(parts) == 2, n(0) * 60 + n(1)).otherwise(fault)


def vtt_stamp(seconds: Column) -> Column:
    """HH:MM:SS.mmm, milliseconds cut off rather than rounded, from what is left beside whole seconds."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60, F.floor((seconds - whole) * 1000).cast("long"))


def parse_vtt(content: Column) -> Column:
    """Cues array<struct<start,end,text>> of a WebVTT file's text, blank ones left out."""
    blocks = F.split(F.regexp_replace(content, r"\r\n?", "\n"), r"\n[ \t]*\n+")
    timing = r"(?m)^[ \t]*([\d:.,]+)[ \t]+-->[ \t]+([\d:.,]+).*$"
    timed = F.filter(blocks, lambda b: b.rlike(timing))
    cues = F.transform(
        timed,
        lambda b: F.struct(
            F.round(vtt_seconds(F.regexp_extract(b, timing, 1)), 3).alias("start"),
            F.round(vtt_seconds(F.regexp_extract(b, timing, 2)), 3).alias("end"),
            clean_lines(F.regexp_replace(F.regexp_extract(b, r"(?s)-->[^\n]*\n(.*?)\n*$", 1), r"<[^>]*>", "")).alias("text"),
        ),
    )
    return F.filter(cues, lambda c: strip(c["text"]) != "")


def consolidate(cues: Column, max_window: float = 90.0, min_words: int = 1) -> Column:
    """Segments of cues: one ends behind a sentence's end or after max_window seconds, once it has min_words.

    A segment that is too short goes on, whatever its window.
    """
    buffer = "array<string>"
    state = F.struct(F.lit(None).cast(buffer).alias("b"), F.lit(None).cast("double").alias("s"), F.lit(None).cast("double").alias("e"), F.array().cast(f"array<{SEGMENT}>").alias("out"))

    def segment(a):
        return F.struct(F.round(a["s"], 3).alias("start"), F.round(a["e"], 3).alias("end"), F.array_join(a["b"], " ").alias("text_raw"))

    def enough(a):
        return (F.size(a["b"]) > 0) & (F.size(words(F.array_join(a["b"], " "))) >= min_words)

    def take(a, cue):
        lines = F.filter(F.transform(F.split(cue["text"], LINE_BREAK), strip), lambda line: line != "")
        said = strip(F.array_join(lines, " "))
        held = F.coalesce(a["b"], F.array().cast(buffer))
        joined = F.struct(
            F.when(said != "", F.concat(held, F.array(said))).otherwise(held).alias("b"),
            F.coalesce(a["s"], cue["start"]).alias("s"),
            cue["end"].alias("e"),
            a["out"].alias("out"),
        )
        ends = said.rlike("[.!?][\\x27\\x22]?$")

        def flush(x):
            done = (ends | (x["e"] - x["s"] >= max_window)) & enough(x)
            empty = F.struct(F.array().cast(buffer).alias("b"), F.lit(None).cast("double").alias("s"), F.lit(None).cast("double").alias("e"), F.concat(x["out"], F.array(segment(x))).alias("out"))
            return F.when(done, empty).otherwise(x)

        return let(joined, flush)

    return F.aggregate(cues, state, take, lambda a: F.when(a["s"].isNotNull() & enough(a), F.concat(a["out"], F.array(segment(a)))).otherwise(a["out"]))


def sentences_strict(text: Column) -> Column:
    """Sentences that end in .!? before a capital, digit or quote."""
    return F.filter(F.transform(F.split(text, rf"(?U){WS}(?<=[.!?]{WS}){WS}*+(?=[A-Z0-9\x22\x27])"), strip), lambda s: s != "")


def sentences_loose(text: Column) -> Column:
    """Sentences that end in .?! before white space."""
    return F.filter(F.transform(F.split(text, SENTENCE_END), strip), lambda s: s != "")


def merge_fragments(lines: Column) -> Column:
    """Lines that begin in lower case go to the end of the line before."""

    def joined(v):
        # Each line that begins anew, with what follows up to the next such line: one pass, whatever the number of lines.
        stop = lambda k: F.coalesce(F.get(v["first"], k + 1), F.size(v["lines"]))
        return F.transform(v["first"], lambda i, k: F.array_join(F.slice(v["lines"], i + 1, stop(k) - i), " "))

    def begun(all_):
        places = F.transform(all_, lambda line, i: F.when((i == 0) | ~line.rlike(r"^\p{IsLowercase}"), i))
        return F.struct(all_.alias("lines"), F.filter(places, lambda i: i.isNotNull()).alias("first"))

    return let(lines, lambda all_: let(begun(all_), joined))


def stitch(segments: DataFrame, nominal_step: float | None = None) -> DataFrame:
    """Segments (doc, chunk, idx, start, end, text) of audio chunks on one time line.

    A chunk begins where the last segment before it ended, or at its nominal
    place if a step is given. An empty chunk keeps the offset.
    """
    if nominal_step is not None:
        offset = F.col("chunk") * nominal_step
        placed = segments.withColumn("offset", offset)
    else:
        last = segments.groupBy("doc", "chunk").agg(F.max_by("end", "idx").alias("last"))
        before = Window.partitionBy("doc").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = last.withColumn("offset", F.coalesce(F.sum("last").over(before), F.lit(0.0))).drop("last")
        placed = segments.join(offsets, ["doc", "chunk"])
    return placed.select("doc", "chunk", "idx", (F.col("start") + F.col("offset")).alias("start"), (F.col("end") + F.col("offset")).alias("end"), "text")


def segment_rows(docs: DataFrame, segments: str = "segments", source: str = "source", video_id: str = "video_id") -> DataFrame:
    """One row per segment with its id, place and duration, from documents with a segments array."""
    rows = docs.select(source, video_id, F.posexplode(segments).alias("segment_index", "s"))
    return rows.select(
        F.concat(F.col(source), F.lit("_"), F.lpad(F.col("segment_index").cast("string"), 5, "0")).alias("id"),
        F.col(source).alias("source"),
        "segment_index",
        F.col("s.start").alias("start_time"),
        F.col("s.end").alias("end_time"),
        F.round(F.col("s.end") - F.col("s.start"), 3).alias("duration"),
        F.col("s.text_raw").alias("text_raw"),
        F.col(video_id).alias("video_id"),
    )


def window_spans(total: Column, length: float = 600.0, overlap: float = 2.0) -> Column:
    """Overlapping windows array<struct<idx,start,duration>> over a duration."""
    step = length - overlap
    if step <= 0:
        raise ValueError("the overlap has to be shorter than the window")
    count = F.ceil(total / F.lit(step)).cast("int")
    spans = F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
        lambda i: F.struct(i.alias("idx"), (i * step).alias("start"), F.least(F.lit(length), total - i * step).alias("duration")),
    )
    return F.when(total > 0, spans).otherwise(F.array().cast("array<struct<idx:int,start:double,duration:double>>"))
