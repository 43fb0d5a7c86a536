"""Hybrid search: vector retrieval, literal reranking, dedup, fallback and snippets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import contains_literal, snippet
from ..functions.vectors import cosine

TOP_K, MIN_SCORE, SUMMARY_BOOST, SNIPPET_CHARS = 25, 0.3, 0.025, 350
N_SUMMARIES, N_TRANSCRIPTS = 5, 250
ALPHA_SUMMARIES, ALPHA_TRANSCRIPTS = 0.2, 0.7
FALLBACK_SCORE = 0.2
SUMMARY, TRANSCRIPT = "summary", "raw_transcript"
#: Decimals of scores, which are sums of products.
SCORE_DECIMALS = 9


def query_column(vector: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


def retrieve(index: DataFrame, vector: list[float] | Column, n: int, category: str | None = None, min_similarity: float | None = None) -> DataFrame:
    """The n rows of an index (id, embedding, category, …) nearest to a vector by cosine: exact, without a shuffle of the index."""
    rows = index if category is None else index.filter(F.col("category") == category)
    query = vector if isinstance(vector, Column) else query_column(vector)
    scored = rows.withColumn("similarity", cosine(F.col("embedding"), query)).drop("embedding")
    if min_similarity is not None:
        scored = scored.filter(F.col("similarity") >= min_similarity)
    return scored.orderBy(F.desc("similarity"), "id").limit(n)


def literal_boost(score: Column, text: Column, query: str, boost: float = 0.5, demote: float = 0.5) -> Column:
    return F.when(contains_literal(text, query), score + boost).otherwise(score * demote)


def hybrid_score(score: Column, text: Column, query: str, alpha: float = 0.3, literal: float = 1.0) -> Column:
    hit = F.when(contains_literal(text, query), F.lit(literal)).otherwise(F.lit(0.0))
    return F.lit(alpha) * score + F.lit(1.0 - alpha) * hit


def aggregate(hits: DataFrame, query: str, boost: float = SUMMARY_BOOST) -> DataFrame:
    """Hits (id, source, category, chunk_index, document, score) once per summary source and per transcript chunk.

    Of hits with the same key the best stays, summaries before transcripts;
    summaries are boosted, and each gets a snippet.
    """
    is_summary = F.col("category") == SUMMARY
    key = F.when(is_summary, F.concat(F.lit("SUMMARY_"), F.col("source"))).otherwise(F.concat_ws("_", F.lit("TRANSCRIPT"), "source", F.col("chunk_index").cast("string")))
    order = Window.partitionBy("_key").orderBy(F.when(is_summary, 0).otherwise(1), F.desc("score"), "id")
    first = hits.withColumn("_key", key).withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    score = F.round(F.when(is_summary, F.col("score") + boost).otherwise(F.col("score")), SCORE_DECIMALS)
    return first.select("id", F.col("source").alias("heading"), "category", "chunk_index", snippet(F.col("document"), query, SNIPPET_CHARS).alias("snippet"), score.alias("score"))


def literal_fallback(files: DataFrame, query: str, score: float = FALLBACK_SCORE) -> DataFrame:
    """Files (source, category, document) that hold the query literally, at a fixed score."""
    hits = files.filter(contains_literal(F.col("document"), query))
    return hits.select(
        F.concat(F.lit("LITERAL_"), F.col("source")).alias("id"),
        F.col("source").alias("heading"),
        "category",
        F.lit(None).cast("int").alias("chunk_index"),
        snippet(F.col("document"), query, SNIPPET_CHARS).alias("snippet"),
        F.lit(score).alias("score"),
    )


def search(
    index: DataFrame, files: DataFrame, query: str, vector: list[float] | Column, strategy: str = "hybrid", top_k: int = TOP_K, min_score: float = MIN_SCORE, fallback_score: float = FALLBACK_SCORE,
    near: Callable[[int, str], DataFrame] | None = None,
) -> DataFrame:
    """The ranked results of a query, as one plan; an empty query has none.

    index: (id, document, embedding, source, category, chunk_index); files:
    (source, category, document), searched literally for what retrieval missed.
    near(n, category) gives the n nearest rows in place of a scan of the index.
    """
    near = near or (lambda n, category: retrieve(index, vector, n, category))
    found = []
    for category, n, alpha in ((SUMMARY, N_SUMMARIES, ALPHA_SUMMARIES), (TRANSCRIPT, N_TRANSCRIPTS, ALPHA_TRANSCRIPTS)):
        hits = near(n, category)
        text, sim = F.col("document"), F.col("similarity")
        score = hybrid_score(sim, text, query, alpha) if strategy == "hybrid" else literal_boost(sim, text, query)
        found.append(hits.withColumn("score", score))
    ranked = aggregate(found[0].unionByName(found[1]), query)
    extra = literal_fallback(files, query, fallback_score)
    if fallback_score < min_score:
        # The floor would drop every one of them.
        results = ranked
    else:
        results = ranked.unionByName(extra.join(ranked.select("heading").distinct(), "heading", "left_anti"))
    results = results.filter(F.col("score") >= min_score)
    if not query.strip():
        results = results.limit(0)
    return results.orderBy(F.desc("score"), "id").limit(top_k)


def confidence(ranked: DataFrame) -> DataFrame:
    """Adds rank and confidence to a short ranked list: the first three are High."""
    order = Window.orderBy(F.desc("score"), "id")
    rows = ranked.withColumn("rank", F.row_number().over(order))
    return rows.withColumn("confidence", F.when(F.col("rank") <= 3, "High").otherwise("Medium"))
