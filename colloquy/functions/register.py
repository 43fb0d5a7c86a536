"""The text operators as SQL functions of a session, for use in spark.sql().

Scalar functions are stated in SQL. Table functions come from the operators'
own columns, turned into SQL text, so that there is one definition of each; both
kinds are inlined into plans and run in the JVM. In LATERAL joins they take
columns of the table before them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..operators import chunk, segment

#: name(arguments) -> (type, SQL over the arguments).
FUNCTIONS = {
    "token_estimate(t STRING)": ("BIGINT", r"CAST(greatest(1, floor(length(regexp_replace(t, r'(?U)[\s\x1C-\x1F]+', ' ')) / 4)) AS BIGINT)"),
    "words_of(t STRING)": ("ARRAY<STRING>", r"filter(split(t, r'(?U)[\s\x1C-\x1F]+'), w -> w <> '')"),
    "sentences_of(t STRING)": ("ARRAY<STRING>", r"filter(transform(split(t, r'(?U)(?<=[.?!])[\s\x1C-\x1F]+'), s -> regexp_replace(s, r'(?U)^[\s\x1C-\x1F]++|(?<![\s\x1C-\x1F])[\s\x1C-\x1F]++$', '')), s -> s <> '')"),
    "placeholder_id(t STRING)": ("STRING", "substring(sha2(t, 256), 1, 11)"),
    "cosine(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)": (
        "DOUBLE",
        "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x) / (greatest(sqrt(aggregate(a, 0D, (s, x) -> s + x * x)), 1e-10D) * greatest(sqrt(aggregate(b, 0D, (s, x) -> s + x * x)), 1e-10D))",
    ),
}
#: Table functions of a text: name -> (type of an element, the operator that gives a text's elements).
TABLES: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "index_chunks": ("chunk STRING", chunk.index_chunks),
    "sentence_chunks": ("chunk STRING", lambda t: chunk.sentence_chunks(t, 200)),
    "word_chunks": ("chunk STRING", lambda t: chunk.word_chunks(t, 200)),
    "strict_sentences": ("sentence STRING", segment.sentences_strict),
    "lines": ("line STRING", lambda t: segment.merge_fragments(segment.sentences_strict(t))),
    "cues": ("cue STRUCT<start: DOUBLE, `end`: DOUBLE, text: STRING>", segment.parse_vtt),
}
_operator = re.compile(r"('(?:[^'\\]|\\.)*')|(?<![\w`])(<=>|<=|>=|!=|<>|==|[=<>!+\-*/%&|]|(?i:and|or|not)\b)(?=\()", re.S)


def sql_of(column: Column) -> str:
    """SQL text of a column. Operators are printed before their operands, as functions, and are quoted as such here."""
    return _operator.sub(lambda m: m[1] or f"`{m[2]}`", column._jc.node().sql())


def register(spark: SparkSession) -> list[str]:
    """Create the functions as temporary ones; they are inlined into plans, not called as Python."""
    for signature, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    for name, (element, operator) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS TABLE(i INT, {element}) RETURN SELECT posexplode({sql_of(operator(F.col('t')))})")
    return [s.split("(")[0] for s in FUNCTIONS] + list(TABLES)


def register_index(spark: SparkSession, name: str, path: str, category: str | None = None) -> None:
    """Create name(vector): every row of a stored index with its similarity, to be ordered and limited by who asks."""
    from ..sources.versions import VersionedTable

    VersionedTable(spark, path).read().createOrReplaceTempView(f"{name}_rows")
    where = "" if category is None else " WHERE category = '" + category.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(vector ARRAY<DOUBLE>) RETURNS TABLE(id STRING, document STRING, source STRING, category STRING, similarity DOUBLE) "
        f"RETURN SELECT id, document, source, category, cosine(CAST(embedding AS ARRAY<DOUBLE>), vector) FROM {name}_rows{where}"
    )
