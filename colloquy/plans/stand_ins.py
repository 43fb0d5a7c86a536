"""Inputs of the registered queries, made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import spread

QUERY = "the"
KEYWORDS = ["the", "on", "la", "de"]
TERMS = {"the": "THE", "then": "next", "la": "LA", "and": "&"}
VARIANTS = [("ann_and", "and"), ("ann_and", "ann and"), ("heed", "heed"), ("heed", "the heed"), ("leon", "la"), ("leon", "de la")]
PRICED = [("openai", "gpt-4.1-mini"), ("anthropic", "Claude-Haiku"), ("ollama", "mistral"), ("openai", "unheard-of")]
#: A bundle in the layout of its files.
BUNDLE = """
[prompt_router]
city_council = { first = "council_notes", multi = "condense", final = "minutes" }
finance_committee = { first = "money_notes", multi = "figures", final = "budget_minutes" }
committee_of_the_whole = { first = "overview", multi = "condense", final = "committee_minutes" }
zoning_committee = { first = "zoning_notes", multi = "condense", final = "committee_minutes" }
general = { first = "overview", multi = "condense", final = "minutes" }

[classifier_types]
allowed = ["city_council", "finance_committee", "committee_of_the_whole", "zoning_committee", "general"]

[classifier_prompt]
text = "What kind of meeting is this? Context: {context} Text: {text}"

[density_keywords]
keywords = ["the", "on", "la", "de"]
""" + "".join(f'\n[prompts.{name}]\ntext = "{name}: {{text}}"\n' for name in "overview council_notes money_notes zoning_notes condense figures minutes budget_minutes committee_minutes".split())
ROUTES = {
    "general": {"first": "overview", "multi": "condense", "final": "minutes"},
    "finance": {"first": "overview", "multi": "figures", "final": "minutes"},
}
TEMPLATE = "{{as is}} {context}: {text} {{end}}"

#: A meeting file's name for each document; the same in Spark and DuckDB.
FILE_NAME = """concat(substring(md5(CAST(doc_id AS STRING)), 1, 11), '.',
  CASE doc_id % 4 WHEN 0 THEN 'finance_committee' WHEN 1 THEN 'zoning_board' WHEN 2 THEN 'city_council' ELSE 'town_hall' END, '_',
  CASE doc_id % 3 WHEN 0 THEN concat('2024-', CAST(1 + doc_id % 12 AS STRING), '-', CAST(1 + doc_id % 28 AS STRING))
    WHEN 1 THEN concat(CAST(1 + doc_id % 12 AS STRING), '_', CAST(1 + doc_id % 28 AS STRING), '_24') ELSE 'undated' END, '.txt')"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "source")


def dealt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, dealt out to all cores where the table is small."""
    return spread(documents(spark, sf_dir), f"{sf_dir}/documents.parquet")


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the embedding of its number, counted round the embeddings; every tenth is a summary."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    turn = vectors.agg(F.max("vec_id") + 1).scalar()
    category = F.when(F.col("doc_id") % 10 == 0, "summary").otherwise("raw_transcript")
    rows = documents(spark, sf_dir).withColumn("vec_id", F.col("doc_id") % turn).join(vectors, "vec_id")
    return rows.select(
        F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("id"), F.col("text").alias("document"), "embedding", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("source"),
        category.alias("category"), F.lit(0).alias("chunk_index"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    category = F.when(F.col("doc_id") % 10 == 0, "summary").otherwise("raw_transcript")
    return docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("source"), category.alias("category"), F.col("text").alias("document"))


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The embedding of vec_id 0: one row."""
    return table(spark, sf_dir, "embeddings").filter("vec_id = 0").select("embedding").first()[0]


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(role, person_key, aliases): one person for each of 40 conversations' numbers and roles."""
    turns = table(spark, sf_dir, "conversations").select("role", (F.col("conv_id") % 40).alias("n")).distinct()
    key = F.when(F.col("n") % 4 == 0, F.concat("role", F.col("n").cast("string"))).otherwise(F.concat_ws("_", "role", F.concat(F.lit("of"), F.col("n").cast("string"))))
    return turns.select("role", key.alias("person_key"), F.array(F.concat(F.lit(" No. "), F.col("n").cast("string")), F.lit(" ")).alias("aliases"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(role, titles) of all roles but one."""
    roles = table(spark, sf_dir, "conversations").select("role").distinct().filter("role <> 'system'")
    return roles.select("role", F.array(F.upper("role"), F.concat(F.lit("Chief "), "role")).alias("titles"))


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, cues) of conversations: a line is a cue of 20 s; every other one loses its last full stop."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line", "said"))
    said = F.when((F.col("turn") + F.col("line")) % 2 == 1, F.regexp_replace("said", r"[.!?]$", "")).otherwise(F.col("said"))
    turns = turns.select("conv_id", "turn", "line", said.alias("said"))
    grouped = turns.groupBy(F.col("conv_id").alias("doc")).agg(F.sort_array(F.collect_list(F.struct("turn", "line", "said"))).alias("ls"))
    made = F.transform("ls", lambda x, i: F.struct((i * 20.0).alias("start"), (i * 20.0 + 20.0).alias("end"), x["said"].alias("text")))
    return grouped.select("doc", made.alias("cues"))
