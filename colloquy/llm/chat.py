"""Chat formatting by rotating the perspective over a conversation's participants.

For every participant the whole dialogue is rendered with that speaker as the
assistant, the others as users under their names and system turns as they are.
The mask holds the character spans of the assistant's own words, those that a
model would be trained on. A conversation is rendered whole, whatever its
length; only where part_turns is given is it rendered in parts of so many turn
numbers. A turn's text and name cannot open a turn of their own: "<|" in them is
written "< |".

Edge cases: a null role is the participant "unknown"; null and empty texts are
empty turns; turns with equal numbers are ordered by role and text; repeated
rows are repeated turns; null turn numbers come first, in part 0; null conv_ids
are one conversation; a conversation with system turns only has no rows, as has
an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = "system"
#: Values that are added up together.
BLOCK = 256


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _added(values: Column) -> Column:
    """The sums of each first n values, n from 1; for few values."""
    start = F.slice(values, 1, 1)
    return F.aggregate(F.slice(values, 2, BLOCK), start, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def running_sums(values: Column) -> Column:
    """The sums of each first n values of an array<long>, n from 1: in blocks, so that no array grows value by value."""

    def joined(blocks):
        # Block totals are added in blocks too, up to BLOCK ** 2 of them.
        totals = F.transform(blocks, lambda b: F.element_at(b, -1))
        outer = F.transform(_slices(totals), _added)
        before = F.aggregate(outer, F.array(F.lit(0).cast("long")), lambda acc, b: F.concat(acc, F.transform(b, lambda x: x + F.element_at(acc, -1))))
        return _let(before, lambda at: F.flatten(F.transform(blocks, lambda b, k: F.transform(b, lambda x: x + F.get(at, k)))))

    return F.when(F.size(values) > 0, _let(F.transform(_slices(values), _added), joined)).otherwise(F.array().cast("array<long>"))


def _slices(values: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / F.lit(float(BLOCK))).cast("int") - 1), lambda k: F.slice(values, k * BLOCK + 1, BLOCK))


def rotate(turns: DataFrame, part_turns: int | None = None) -> DataFrame:
    """Rows (conv_id, part, speaker, n_turns, rendered, mask): mask is "start-end" spans in code points, end exclusive."""
    part = F.lit(0) if part_turns is None else F.coalesce(F.floor(F.col("turn") / F.lit(float(part_turns))), F.lit(0))
    plain = lambda c, missing: F.replace(F.coalesce(c, F.lit(missing)), F.lit("<|"), F.lit("< |"))
    t = turns.select("conv_id", part.cast("long").alias("part"), F.struct("turn", plain("role", "unknown").alias("role"), plain("text", "").alias("text")).alias("t"))
    speakers = (
        t.select("conv_id", F.col("t.role").alias("role"))
        .filter(F.col("role") != SYSTEM)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_set("role")).alias("speakers"))
    )
    parts = t.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    joined = parts.alias("p").join(speakers.alias("s"), F.col("p.conv_id").eqNullSafe(F.col("s.conv_id")))
    rows = joined.select("p.conv_id", "p.part", "p.ts", F.explode("s.speakers").alias("speaker"))

    def header(x):
        other = F.when(x["role"] == SYSTEM, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user:"), x["role"], F.lit("|>\n")))
        return F.when(x["role"] == F.col("speaker"), F.lit("<|assistant|>\n")).otherwise(other)

    rows = rows.withColumn("heads", F.transform("ts", header))
    pieces = F.zip_with("heads", "ts", lambda h, x: F.concat(h, x["text"], F.lit("\n")))
    rows = rows.withColumn("pieces", pieces)
    rows = rows.withColumn("ends", running_sums(F.transform("pieces", lambda p: F.length(p).cast("long"))))
    spans = F.transform(
        "ts",
        lambda x, i: F.when(
            x["role"] == F.col("speaker"),
            F.concat((F.get("ends", i) - 1 - F.length(x["text"])).cast("string"), F.lit("-"), (F.get("ends", i) - 1).cast("string")),
        ),
    )
    return rows.select(
        "conv_id",
        "part",
        "speaker",
        F.size("ts").cast("long").alias("n_turns"),
        F.array_join("pieces", "").alias("rendered"),
        F.array_join(F.filter(spans, lambda s: s.isNotNull()), ",").alias("mask"),
    )


ORACLE = """
WITH t AS (
  SELECT conv_id, 0::BIGINT AS part, turn, replace(COALESCE(role, 'unknown'), '<|', '< |') AS role, replace(COALESCE(text, ''), '<|', '< |') AS text
  FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (
  SELECT t.*, s.speaker,
         CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>' ELSE '<|user:' || role || '|>' END || chr(10) AS head
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, row_number() OVER w AS k,
         COALESCE(sum(length(head) + length(text) + 1) OVER (PARTITION BY conv_id, part, speaker ORDER BY turn NULLS FIRST, role, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS a
  FROM r WINDOW w AS (PARTITION BY conv_id, part, speaker ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, part, speaker, count(*) AS n_turns,
       string_agg(head || text || chr(10), '' ORDER BY k) AS rendered,
       COALESCE(string_agg(a || '-' || (a + length(text)), ',' ORDER BY k) FILTER (role = speaker), '') AS mask
FROM o GROUP BY conv_id, part, speaker
"""
