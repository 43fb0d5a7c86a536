"""The operators and the pipeline as registered queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, descent, importance, media, mixing, packing, pages, runs, sharding, simhash, suffix, token_counts, variants
from .store import Store


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op2_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_suffix(spark, sf_dir):
    return suffix.removals(_table(spark, sf_dir, "documents"))


def op4_media(spark, sf_dir):
    stored = Store(spark, "media").save(media.store_media(_table(spark, sf_dir, "documents")), compression="zstd")
    return media.digests(stored)


def op5_descent(spark, sf_dir):
    return descent.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_importance(spark, sf_dir):
    found = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_features", "log_weight", "kept")


def op10_chat(spark, sf_dir):
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, budget=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_variants(spark, sf_dir):
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_runs(spark, sf_dir):
    return runs.document_runs(_table(spark, sf_dir, "documents"))


def op13_pages(spark, sf_dir):
    return pages.main_text(_table(spark, sf_dir, "pages"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_suffix": op3_suffix,
    "op4_media": op4_media,
    "op5_descent": op5_descent,
    "op6_sharding": op6_sharding,
    "op7_token_counts": op7_token_counts,
    "op8_importance": op8_importance,
    "op9_simhash": op9_simhash,
    "op10_chat": op10_chat,
    "op11_variants": op11_variants,
    "op12_runs": op12_runs,
    "op13_pages": op13_pages,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op6_sharding": sharding.oracle(), "op10_chat": chat.ORACLE}
