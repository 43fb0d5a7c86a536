"""Small column helpers that the operators share."""

from __future__ import annotations

import ctypes
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .store import bound_batches

#: A word is a run of bytes other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_count(text: Column) -> Column:
    """UTF-8 bytes of a text; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def give_back() -> None:
    """Return a worker's free memory to the system: workers are used again by later stages, and keep it otherwise."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # other systems have no such call
        pass


def lean(run):
    """The function of mapInPandas, giving back memory at the end of each task."""

    @wraps(run)
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def row_hash(rows: DataFrame) -> Column:
    """A hash of all columns of a row; rows with one hash, id and text count as the same row repeated."""
    each = [F.col(f"`{f.name}`") if "map<" not in f.dataType.simpleString() else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in rows.schema]
    return F.xxhash64(F.lit(7), *each, F.concat_ws("", *[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in rows.columns]))


def id_text(key: Column) -> Column:
    """An id as text that is never null, so that equal ids meet in plain joins."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("-"))


def held(rows: DataFrame, **own: Column) -> DataFrame:
    """The rows as one column `row`, beside columns of our own, whose names then clash with none of theirs."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    return rows.select(row, *[value.alias(name) for name, value in own.items()])


def released(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that held() put into `row`."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def map_batches(rows: DataFrame, run, schema: StructType, key: str = "doc_id") -> DataFrame:
    """rows.mapInPandas(run, schema) with the key carried as text and put back to its type.

    pandas turns whole numbers beside nulls into floats, and large ids would
    lose their last digits.
    """
    kind = rows.schema[key].dataType
    bound_batches(rows.sparkSession)
    carried = StructType([StructField(key, StringType()) if f.name == key else f for f in schema])
    out = rows.withColumn(key, F.col(key).cast("string")).mapInPandas(lean(run), carried)
    return out.withColumn(key, F.col(key).cast(kind))
