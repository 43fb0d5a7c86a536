"""Labels, dates and ids that file names carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: The dates that are looked for in names, and the address of a video.
ISO_DATE = r"(\d{4}[-_]\d{1,2}[-_]\d{1,2})"
US_DATE = r"(\d{1,2}[-_]\d{1,2}[-_]\d{2,4})"
WATCH = "https://www.youtube.com/watch?v="


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def document_type(name: Column) -> Column:
    """finance, zoning or council by what the name holds, first match wins; else general."""
    low = F.lower(name)
    held = lambda s: F.contains(low, F.lit(s))
    return F.when(held("finance") | held("budget"), "finance").when(held("zoning"), "zoning").when(held("council"), "council").otherwise("general")


def _found(name: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))


def file_date(name: Column) -> Column:
    """The first ISO-like date, else the first US-like one, as it stands but with dashes; else unknown."""
    return F.translate(F.coalesce(_found(name, ISO_DATE), _found(name, US_DATE), F.lit("unknown")), "_", "-")


def file_id(name: Column) -> Column:
    """The 11 characters before the first dot; null where there are more or fewer."""
    head = F.substring_index(name, ".", 1)
    return F.when(F.contains(name, F.lit(".")) & (F.length(head) == 11), head)


def watch_url(video_id: Column) -> Column:
    return F.concat(F.lit(WATCH), video_id)


def placeholder_id(base: Column) -> Column:
    """A stable id for a source without one: the first 11 hex digits of its name's SHA-256."""
    return F.substring(F.sha2(base, 256), 1, 11)


def title_case(text: Column) -> Column:
    """Every run of letters capitalized, as in O'Neil and 3Rd."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def label_and_date(path: Column) -> tuple[Column, Column]:
    """(label | date, date) of a transcript or summary file; dates are put in order and padded."""
    base = base_name(path)
    for suffix in (".txt", ".summary.md", ".punct"):
        base = F.replace(base, F.lit(suffix), F.lit(""))
    iso, us = _found(base, ISO_DATE), _found(base, US_DATE)
    raw = F.coalesce(iso, us)
    parts = F.split(raw, "[-_]")
    year = F.when(iso.isNotNull(), F.get(parts, 0)).otherwise(F.get(parts, 2))
    month = F.when(iso.isNotNull(), F.get(parts, 1)).otherwise(F.get(parts, 0))
    day = F.when(iso.isNotNull(), F.get(parts, 2)).otherwise(F.get(parts, 1))
    year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    date = F.coalesce(F.concat_ws("-", year, two(month), two(day)), F.lit(""))
    date = F.when(raw.isNull(), "0000-00-00").otherwise(date)
    label = F.when(raw.isNull(), base).otherwise(F.replace(base, raw, F.lit("")))
    label = F.when(F.contains(label, F.lit(".")), F.regexp_replace(label, r"^[^.]*\.", "")).otherwise(label)
    label = title_case(strip(F.regexp_replace(F.translate(label, "_-", "  "), r"(?U)\s+", " ")))
    label = F.when(label == "", "Meeting Transcript").otherwise(label)
    return F.concat_ws(" | ", label, date), date


def prompt_context(path: Column, note: str | None = None) -> Column:
    """Kind and date of a meeting from its file name, for prompts."""
    base = F.regexp_replace(base_name(path), r"(?U)^[\w\-]+?\.", "")
    base = F.translate(F.replace(base, F.lit(".txt"), F.lit("")), "_-", "  ")
    pattern = r"^(.*?) (\d{1,2})[ -](\d{1,2})[ -](\d{2,4})"
    part = lambda i: F.regexp_extract(base, pattern, i)
    number = lambda i: F.expr("null").cast("int") if i is None else part(i).try_cast("int")
    year = F.when(number(4) < 100, number(4) + 2000).otherwise(number(4))
    dated = F.concat(title_case(strip(part(1))), F.lit(" - "), F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(number(2).cast("string"), 2, "0"), F.lit("-"), F.lpad(number(3).cast("string"), 2, "0"))
    context = F.when(base.rlike(pattern), dated).otherwise(title_case(base))
    return context if not note else F.concat(context, F.lit(f" ({note.strip()})"))


def summary_name(transcript: Column) -> Column:
    """The summary file that belongs to a transcript file."""
    return F.replace(transcript, F.lit(".txt"), F.lit(".summary.md"))


def segment_id(source: Column, index: Column) -> Column:
    return F.concat(source, F.lit("_"), F.lpad(index.cast("string"), 5, "0"))
