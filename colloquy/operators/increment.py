"""Incremental work: trackers, listings, collisions and stage reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_file_name, strip
from ..sources.scratch import written


def tracker_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct non-blank keys of a tracker's lines."""
    return lines.select(strip(F.col(column)).alias("key")).filter("key <> ''").distinct()


def pending(items: DataFrame, processed: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Items whose key isn't among the processed ones; all of them if forced."""
    if force:
        return items
    return items.join(processed.select(F.col("key").alias(key)), key, "left_anti")


def content_key(content: Column, prefix: Column | None = None) -> Column:
    """SHA-256 of content, behind an id if there is one."""
    digest = F.sha2(content, 256)
    return digest if prefix is None else F.concat(prefix, F.lit(":"), digest)


def id_map(lines: DataFrame, value: str = "value", order: str = "line") -> DataFrame:
    """(lower_id, real_id) from lines of 11 characters; the last of a kind wins."""
    ids = lines.withColumn("_id", strip(F.col(value))).filter(F.length("_id") == 11)
    return ids.groupBy(F.lower("_id").alias("lower_id")).agg(F.max_by("_id", order).alias("real_id"))


def within_dates(listing: DataFrame, after, before, date: str = "upload_date", order: str = "position", per: list[str] = ()) -> DataFrame:
    """Items of a listing, newest first, from after to before; reading stops at the first that is too old.

    per names the columns of several listings in one. The place to stop at is a
    partial minimum, so no listing has to be sorted in one task.
    """
    old = listing.filter(F.col(date) < after)
    young = F.col(date) <= before
    if not per:
        stop = old.agg(F.min(order)).scalar()
        return listing.filter(young & F.coalesce(F.col(order) < stop, F.lit(True)))
    stops = old.groupBy(*per).agg(F.min(order).alias("_stop"))
    return listing.join(stops, list(per), "left").filter(young & F.coalesce(F.col(order) < F.col("_stop"), F.lit(True))).drop("_stop")


def fresh_listing(cache: DataFrame, now: Column, max_age: int = 86_400) -> DataFrame:
    """Cached listings (fetched_at, channel, video_ids) that are well formed and young enough."""
    return cache.filter(F.col("video_ids").isNotNull() & F.col("fetched_at").isNotNull() & (now - F.col("fetched_at") <= max_age))


def clean_names(files: DataFrame, name: str = "name", per: list[str] = ()) -> DataFrame:
    """Adds clean_name, which no two rows of a folder (the columns per) share.

    A name that is clean already stays; of the others with one clean name the
    first takes it, if it is free, and each further one the next _1, _2 and so on
    that is no file's clean name.
    """
    row, folder = F.struct(*[F.col(f"`{c}`") for c in files.columns]).alias("_row"), [F.col(c).alias(f"_p{i}") for i, c in enumerate(per)]
    keys = [f"_p{i}" for i in range(len(per))]
    cleaned = files.select(row, *folder, F.col(name).alias("_name"), clean_file_name(F.col(name)).alias("_c"))
    ranked = written(cleaned.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_c").orderBy(F.col("_name") != F.col("_c"), "_name", F.xxhash64("_row"))) - 1), "names")
    parts = lambda c, pattern: [F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]
    # Clean names that read like a numbered one of another take that number from it.
    base, number, ext = parts("_c", r"^(.*)_([1-9][0-9]{0,17})(\.[^.]*)?$")
    taken = ranked.select(*keys, F.concat(base, ext).alias("_c"), number.try_cast("long").alias("_k")).filter("_k IS NOT NULL").distinct()
    wanted = ranked.groupBy(*keys, "_c").agg(F.max("_r").cast("long").alias("_most")).filter("_most > 0")
    held = taken.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_held"))
    tried = wanted.join(held, [*keys, "_c"], "left").withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_most") + F.coalesce("_held", F.lit(0)))))
    free = tried.join(taken, [*keys, "_c", "_k"], "left_anti").withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_c").orderBy("_k")))
    given = ranked.join(free.select(*keys, "_c", "_r", "_k"), [*keys, "_c", "_r"], "left")
    stem, ext = F.regexp_extract("_c", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("_c", r"^(.*?)(\.[^.]*)?$", 2)
    numbered = F.concat(stem, F.lit("_"), F.col("_k").cast("string"), ext)
    return given.select("_row.*", F.when(F.col("_r") == 0, F.col("_c")).otherwise(numbered).alias("clean_name"))


def stage_report(items: DataFrame, processed: Column, skipped: Column) -> DataFrame:
    """One row: discovered, processed, skipped."""
    return items.agg(F.count(F.lit(1)).alias("discovered"), F.count_if(processed).alias("processed"), F.count_if(skipped).alias("skipped"))


def first_by_content(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(content_sha, first_id, copies) of distinct contents."""
    return docs.groupBy(content_key(F.col(text)).alias("content_sha")).agg(F.min(key).alias("first_id"), F.count(F.lit(1)).alias("copies"))
