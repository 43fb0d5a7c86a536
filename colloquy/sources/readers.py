"""Files as DataFrames: transcripts, captions, segments, trackers, summaries and media."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import meta
from ..operators.segment import parse_vtt

SEGMENTS = "id string, source string, segment_index int, start_time double, end_time double, duration double, text_raw string, video_id string, embedding array<float>"
LISTING = "fetched_at long, channel string, video_ids array<string>"


def _path() -> Column:
    return F.col("_metadata.file_path")


def _glob(suffix: str) -> str:
    """A pattern of file names that end in a suffix, case aside."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def _check(spark: SparkSession, path: str, suffixes: list[str]) -> None:
    """An error where there is nothing at a path, or a single file with another suffix."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(location):
        raise FileNotFoundError(f"no file or folder at {path}")
    if system.getFileStatus(location).isFile() and not path.lower().endswith(tuple(s.lower() for s in suffixes)):
        raise ValueError(f"{path} ends with none of {', '.join(suffixes)}")


def discover(spark: SparkSession, path: str, suffixes: list[str], exclude_suffix: str | None = None) -> DataFrame:
    """(path, name, length) of a file, or of a folder's own files with one of the suffixes, case aside, in order of path.

    A path that isn't there and a single file with another suffix are errors.
    """
    _check(spark, path, suffixes)
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path).select("path", "length")
    rows = rows.withColumn("name", meta.base_name(F.col("path")))
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.lower("name").endswith(s.lower())
    rows = rows.filter(ends)
    if exclude_suffix:
        rows = rows.filter(~F.lower("name").endswith(exclude_suffix.lower()))
    return rows.orderBy("path")


def texts(spark: SparkSession, path: str, suffix: str = ".txt", exclude_suffix: str | None = None) -> DataFrame:
    """(source, text) of whole files that end in the suffix, case aside; errors are discover()'s."""
    _check(spark, path, [suffix])
    rows = spark.read.option("pathGlobFilter", _glob(suffix)).text(path, wholetext=True)
    rows = rows.select(meta.base_name(_path()).alias("source"), F.col("value").alias("text"))
    return rows.filter(~F.lower("source").endswith(exclude_suffix)) if exclude_suffix else rows


def captions(spark: SparkSession, path: str) -> DataFrame:
    """(source, cues) of WebVTT files, each read whole; errors are discover()'s."""
    _check(spark, path, [".vtt"])
    rows = spark.read.option("pathGlobFilter", _glob(".vtt")).text(path, wholetext=True)
    return rows.select(meta.stem(_path()).alias("source"), parse_vtt(F.col("value")).alias("cues"))


def cue_rows(spark: SparkSession, path: str, stream: bool = False, since: str | None = None, suffix: str = ".vtt") -> DataFrame:
    """(source, place, start, end, text, ...) of the cues of WebVTT files, one row each, as a table or a stream.

    A record of the text reader is what lies between blank lines, so a file
    larger than a split is read by several tasks, cut at cues; a file whose
    lines end in CR LF is one record, and is right as well. place orders a file's
    cues. since leaves out files that were modified before, unread. Columns of
    partitioned folders stay, and a stream takes files up as they land.
    """
    if stream:
        reader = spark.readStream.schema("value string")
    else:
        _check(spark, path, [suffix])
        reader = spark.read
    rows = reader.option("pathGlobFilter", _glob(suffix)).option("lineSep", "\n\n").format("text").load(path)
    if since is not None:
        rows = rows.filter(F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp"))
    folders = [F.col(c) for c in rows.columns if c != "value"]
    start = F.col("_metadata.file_block_start")
    place = F.struct(_path().alias("file"), start.alias("start"), (F.lit(0).cast("long") if stream else F.monotonically_increasing_id()).alias("row"))
    cues = rows.select(meta.stem(_path()).alias("source"), *folders, place.alias("_p"), F.posexplode(parse_vtt(F.col("value"))).alias("_i", "c"))
    return cues.select("source", *folders, F.struct("_p.*", F.col("_i").alias("cue")).alias("place"), "c.start", "c.end", "c.text")


def gathered(cues: DataFrame, key: str = "source") -> DataFrame:
    """(key, cues) from cue_rows, each file's cues in their order, as captions() has them."""
    listed = F.sort_array(F.collect_list(F.struct("place", F.struct("start", "end", "text").alias("c"))))
    return cues.groupBy(key).agg(F.transform(listed, lambda x: x["c"]).alias("cues"))


def segments(spark: SparkSession, path: str, with_embedding: bool = False) -> DataFrame:
    """Segments of JSON-lines files; those with an embedding only, if asked."""
    rows = spark.read.schema(SEGMENTS).json(path)
    return rows.filter("embedding IS NOT NULL") if with_embedding else rows


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, line) of text files; line orders them by file and place. None where the path is missing."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location):
        return spark.createDataFrame([], "value string, line struct<file:string,start:long,row:long>")
    # Rows of one stretch of a file are numbered as they are read.
    place = F.struct(_path().alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select("value", place.alias("line"))


def listings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LISTING).json(path)


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """(source, text, label, date) of summary files, newest first."""
    rows = texts(spark, path, ".summary.md")
    label, date = meta.label_and_date(F.col("source"))
    return rows.select("source", "text", label.alias("label"), date.alias("date")).orderBy(F.desc("date"), "source")


def media(spark: SparkSession, path: str, suffixes: list[str]) -> DataFrame:
    """(path, name, length, sha256) of media files."""
    rows = spark.read.format("binaryFile").load(path)
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.lower("path").endswith(s.lower())
    return rows.filter(ends).select("path", meta.base_name(F.col("path")).alias("name"), "length", F.sha2("content", 256).alias("sha256"))
