"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept: low-quality and toxic
documents go, one document of each near-duplicate group stays, passages that
other documents repeat are cut, sources are mixed to their weights, and the
result is packed.

Every stage takes null ids and texts, blank and very long texts, repeated rows,
several texts under one id, empty tables and further columns of any name. A
null, empty or white-space text holds no words: quality drops it, and where a
stage is run by itself such texts are alike to near_dedup, which keeps one,
passage_dedup leaves them as they are, mix never takes them, and pack gives them
the end id alone. Of rows that near_dedup takes for the same it keeps the one
with the smallest doc_id, nulls last, then the smallest digest of its text, then
the smallest hash of all its columns. Rows that are equal in all columns are
rows of their own to the other stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import importance, mixing, packing, resemblance, suffix
from colloquy.llm.store import Store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return importance.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8 or more."""
    return resemblance.keep_first(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that start twice; n_chars follows the text, and stays beside a null one."""
    rows = suffix.cut_texts(docs)
    return rows.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in rows.columns else rows


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: Hashed models, Hamming links, suffix ranks and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents, each written before the next."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
