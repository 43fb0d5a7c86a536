"""Summaries in several passes: chunk, generate, join, until the text is small enough.

Generation is a column function of (prompt, text); models go in as pandas UDFs.
The built-in one is extractive: it takes each chunk's first sentences, so plans
run and can be tested without a model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens
from ..functions.text import excerpt, render_prompt
from ..sources.scratch import written
from .chunk import chunk_text, pass_threshold
from .ledger import Ledger
from .route import GENERAL, RULES, classify_rules, label_of, route_of
from .segment import sentences_loose

Generate = Callable[[Column, Column], Column]

PROMPTS = {
    "overview": "Write short notes on what this part of a meeting is about.\nContext: {context}\n\n{text}",
    "condense": "Shorten these notes; keep names, votes and amounts.\nContext: {context}\n\n{text}",
    "minutes": "Turn these notes into minutes under headings.\nContext: {context}\n\n{text}",
}
ROUTES = {label: {"first": "overview", "multi": "condense", "final": "minutes"} for label in (GENERAL, *RULES)}


def extractive(prompt: Column, text: Column, sentences: int = 2) -> Column:
    """The first sentences of a text."""
    return F.array_join(F.slice(sentences_loose(text), 1, sentences), " ")


#: Generators by provider. The built-in one stands for each until a model is put in its place.
PROVIDERS: dict[str, Generate] = dict.fromkeys(("ollama", "openai", "llamacpp", "anthropic", "codex_cli"), extractive)


def generator(provider: str, providers: dict[str, Generate] | None = None) -> Generate:
    """The generator of a provider, its name taken regardless of case and blanks around."""
    known = PROVIDERS | (providers or {})
    name = (provider or "").strip().lower()
    if not name:
        raise ValueError("no provider is named")
    if name not in known:
        raise ValueError(f"unknown provider: {provider}; there are {', '.join(sorted(known))}")
    return known[name]


def _prompt(name: Column, prompts: dict[str, str], text: Column, context: Column) -> Column:
    made = None
    for key, template in prompts.items():
        one = render_prompt(template, text, context)
        made = F.when(name == key, one) if made is None else made.when(name == key, one)
    return made


def summarize(
    docs: DataFrame,
    generate: Generate = extractive,
    style: str = "word",
    max_tokens: int = 3000,
    max_pass: int = 3,
    keywords: list[str] = (),
    prompts: dict[str, str] = PROMPTS,
    routes: dict[str, dict[str, str]] = ROUTES,
    classify: Generate | None = None,
    classifier: str = "{text}",
    labels: list[str] | None = None,
    first: str | None = None,
    multi: str | None = None,
    final: str | None = None,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Rows (doc_id, meeting_type, summary, passes, input_tokens, output_tokens, total_tokens) for (doc_id, text[, context]).

    The kind of meeting is told by rules, or by classify, a model whose answer to
    the classifier prompt is searched for the labels, by default the routes'.
    first, multi and final name prompts that take the place of the routes'. A
    document is finished at the first of: the last pass, or from the second pass
    on one chunk or a text within max_tokens. Finished documents leave the loop.
    Each pass is written and read again, so no call is made twice; with a ledger
    no run calls for what an earlier one was answered. A row is a document,
    whatever its id: ids may repeat and be null.
    """
    if max_pass < 1:
        raise ValueError("max_pass has to be 1 or more")
    for name in (first, multi, final):
        if name is not None and name not in prompts:
            raise ValueError(f"unknown prompt: {name}")

    def said_to(rows: DataFrame, model: Generate, prompt: str, text: str, into: str) -> DataFrame:
        return ledger.ask(rows, model, prompt, text, into) if ledger else rows.withColumn(into, model(F.col(prompt), F.col(text)))

    context = F.col("context") if "context" in docs.columns else F.lit(None).cast("string")
    if classify is None:
        label = classify_rules(F.col("text"), labels=list(routes))
    else:
        docs = docs.withColumn("_prompt", render_prompt(classifier, excerpt(F.col("text")), context)).withColumn("_excerpt", excerpt(F.col("text")))
        docs = said_to(docs, classify, "_prompt", "_excerpt", "_said")
        label = label_of(F.col("_said"), list(routes) if labels is None else labels)
    work = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), context.alias("context"), label.alias("meeting_type"))
    route = route_of(F.col("meeting_type"), routes, first, multi, final)
    work = work.withColumn("route", route).withColumn("n_in", tokens.estimate(F.substring("text", 1, 2000))).withColumn("n_out", tokens.estimate(F.col("meeting_type")))
    work = written(work, "meetings")
    finished = None
    for number in range(1, max_pass + 1):
        chunks = work.select("_row", "context", F.col("route." + ("first" if number == 1 else "multi")).alias("name"), F.posexplode(chunk_text(F.col("text"), style, max_tokens, keywords, pass_threshold(number))).alias("part", "chunk"))
        chunks = chunks.withColumn("prompt", _prompt(F.col("name"), prompts, F.col("chunk"), F.col("context")))
        chunks = said_to(chunks, generate, "prompt", "chunk", "said")
        joined = chunks.groupBy("_row").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "said"))), lambda x: x["said"]), "\n\n").alias("next"),
            F.count(F.lit(1)).alias("chunks"),
            F.sum(tokens.estimate(F.col("prompt"))).alias("add_in"),
            F.sum(tokens.estimate(F.col("said"))).alias("add_out"),
        )
        work = work.join(joined, "_row", "left")
        work = work.withColumn("text", F.coalesce("next", F.lit(""))).withColumn("n_in", F.col("n_in") + F.coalesce("add_in", F.lit(0))).withColumn("n_out", F.col("n_out") + F.coalesce("add_out", F.lit(0)))
        small = (tokens.estimate(F.col("text")) <= max_tokens) | (F.coalesce("chunks", F.lit(0)) <= 1)
        work = work.withColumn("done", F.lit(True) if number == max_pass else (small if number >= 2 else F.lit(False)))
        work = written(work.drop("next", "chunks", "add_in", "add_out"), "meetings")
        done = work.filter("done").withColumn("passes", F.lit(number))
        finished = done if finished is None else finished.unionByName(done)
        work = work.filter(~F.col("done")).drop("done")
    last = finished.withColumn("prompt", _prompt(F.col("route.final"), prompts, F.col("text"), F.col("context")))
    last = said_to(last, generate, "prompt", "text", "summary")
    n_in, n_out = F.col("n_in") + tokens.estimate(F.col("prompt")), F.col("n_out") + tokens.estimate(F.col("summary"))
    return last.select("doc_id", "meeting_type", "summary", "passes", n_in.alias("input_tokens"), n_out.alias("output_tokens"), (n_in + n_out).alias("total_tokens"))


def response_text(provider: str, body: Column) -> Column:
    """The text in a provider's stored answer."""
    if provider == "ollama":
        lines = F.filter(F.split(body, "\n"), lambda x: F.trim(x) != "")
        return F.array_join(F.transform(lines, lambda x: F.coalesce(F.get_json_object(x, "$.response"), F.lit(""))), "")
    if provider == "openai":
        blocks = F.from_json(F.get_json_object(body, "$.output"), "array<struct<content:array<struct<text:string>>>>")
        texts = F.flatten(F.transform(blocks, lambda b: F.transform(F.coalesce(b["content"], F.array().cast("array<struct<text:string>>")), lambda c: c["text"])))
        return F.coalesce(F.get_json_object(body, "$.output_text"), F.array_join(texts, ""))
    if provider == "anthropic":
        blocks = F.from_json(F.get_json_object(body, "$.content"), "array<struct<type:string,text:string>>")
        return F.array_join(F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"]), "")
    if provider == "llamacpp":
        return F.get_json_object(body, "$.choices[0].text")
    if provider == "codex_cli":
        return F.trim(body)
    raise ValueError(f"unknown provider: {provider}")
