"""The stages of the engine as plans over folders: slice, normalize, summarize, index, search.

Each skips inputs whose output is already there, unless forced, and returns
what it did. Nothing is collected but the small reports.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import meta, policy, text, tokens
from ..operators import chunk, increment, index, inverted, literal, route, search, segment, summarize
from ..operators.ledger import Ledger
from ..sources import readers, scratch, versions, writers
from .config import ConfigError, PromptBundle, entity_dir, wanted_sources


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def _new(spark: SparkSession, rows: DataFrame, output: str, force: bool, key: str = "source") -> DataFrame:
    """Rows whose key isn't in the Parquet output yet."""
    if force or not _exists(spark, output):
        return rows
    return increment.pending(rows, spark.read.parquet(output).select(F.col(key).alias("key")).distinct(), key)


def id_map(spark: SparkSession, path: str) -> DataFrame:
    """(lower_id, real_id) of a tracker file of ids."""
    return increment.id_map(readers.lines(spark, path))


def pending_uploads(spark: SparkSession, cache: str, dates: DataFrame, tracker: str, now: int, after: str, before: str) -> DataFrame:
    """(channel, video_id, position, upload_date) that are still to be fetched.

    From the fresh listings of a cache, newest first, those within the dates
    (video_id, upload_date), less the ids of the tracker.
    """
    listed = increment.fresh_listing(readers.listings(spark, cache), F.lit(now))
    rows = listed.select("channel", F.posexplode("video_ids").alias("position", "video_id")).join(dates, "video_id")
    young = increment.within_dates(rows, after, before, per=["channel"])
    return increment.pending(young, increment.tracker_keys(readers.lines(spark, tracker)), "video_id")


def cached_listing(spark: SparkSession, settings: dict) -> DataFrame:
    """(channel, video_id, position) of the listing table in an entity's folder, which stands for the network."""
    folder = entity_dir({"system": settings}, settings["entity"])
    return readers.listings(spark, f"{folder}/listing").select("channel", F.posexplode("video_ids").alias("position", "video_id"))


#: Readers of (channel, video_id, position) by the source's name.
SOURCES: dict[str, Callable[[SparkSession, dict], DataFrame]] = {"youtube": cached_listing}


def fetch_sources(spark: SparkSession, settings: dict, only: str | None = None, adapters: dict | None = None) -> DataFrame:
    """(source, channel, video_id, position) of an entity's declared sources, or of one; a source without an adapter is an error."""
    known, found = SOURCES | (adapters or {}), None
    for name in wanted_sources(settings, only):
        if name not in known:
            raise ConfigError(f"{settings.get('entity')}: no adapter for source {name}")
        rows = known[name](spark, settings).select(F.lit(name).alias("source"), "channel", "video_id", "position")
        found = rows if found is None else found.unionByName(rows)
    return found


def slice_captions(
    spark: SparkSession,
    path: str,
    output: str,
    ids: DataFrame | None = None,
    max_window: float = 90.0,
    min_words: int = 1,
    force: bool = False,
    texts: str | None = None,
    tracker: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Segments of a folder of WebVTT files, appended to output: id, source, place, times, text, video_id.

    texts is a folder for readable transcripts, tracker a file that lists what was done.
    A dry run returns the sources that would be sliced and writes nothing.
    """
    rows = _new(spark, readers.captions(spark, path), output, force)
    if dry_run:
        return rows.select("source")
    head = F.regexp_extract("source", "^[A-Za-z0-9_-]{11}", 0)
    if ids is not None:
        rows = rows.join(ids, F.lower(head) == F.col("lower_id"), "left")
    known = F.col("real_id") if ids is not None else F.lit(None).cast("string")
    rows = rows.withColumn("video_id", F.coalesce(known, meta.placeholder_id(F.col("source")))).withColumn("segments", segment.consolidate(F.col("cues"), max_window, min_words))
    if texts:
        writers.write_texts(rows.select("source", writers.segment_text(F.col("segments")).alias("text")), texts)
    if tracker:
        writers.append_tracker(increment.pending(rows.select("source"), increment.tracker_keys(readers.lines(spark, tracker)), "source"), tracker, "source")
    segment.segment_rows(rows).write.mode("overwrite" if force else "append").parquet(output)
    return spark.read.parquet(output)


def normalize_texts(
    spark: SparkSession,
    path: str,
    output: str,
    replacements: dict[str, str] | None = None,
    deep: bool = False,
    force: bool = False,
    split: Callable[[Column], Column] = segment.sentences_strict,
    dry_run: bool = False,
) -> DataFrame:
    """Normalized transcripts (source, text), one sentence on a line, of a folder of text files, appended to output.

    split gives a text's sentences as an array; a model goes in as a pandas UDF.
    A dry run returns the sources that would be normalized and writes nothing.
    """
    rows = _new(spark, scratch.spread(readers.texts(spark, path, ".txt", "punct.txt"), path), output, force)
    if dry_run:
        return rows.select("source")
    clean = text.normalize_patterns(text.normalize_whitespace(F.col("text")))
    clean = text.replace_terms(text.deep_clean(clean) if deep else clean, replacements or {})
    lines = writers.sentence_lines(segment.merge_fragments(split(clean)))
    rows.select("source", lines.alias("text")).write.mode("overwrite" if force else "append").parquet(output)
    return spark.read.parquet(output)


def _refuse(spark: SparkSession, provider: str, model: str, target: str, allowed: dict) -> None:
    """An error where a provider may not be called at its target, or with that model."""
    faults = spark.range(1).select(policy.target_fault(F.lit(provider), F.lit(target), **allowed), policy.model_fault(F.lit(model))).first()
    for fault in filter(None, faults):
        raise ValueError(f"{provider} at {target}: {fault}")


def summarize_texts(
    spark: SparkSession,
    transcripts: str,
    output: str,
    force: bool = False,
    bundle: PromptBundle | None = None,
    provider: str = "ollama",
    model: str = "extractive",
    target: str = "https://localhost",
    reference: tuple[str, str] = ("", ""),
    allowed: dict | None = None,
    files: str | None = None,
    form: str = "markdown",
    providers: dict[str, summarize.Generate] | None = None,
    dry_run: bool = False,
    ledger: str | None = None,
    **options,
) -> DataFrame:
    """Summaries of normalized transcripts with their prices, appended to output.

    bundle holds prompts, routes, keywords, and the classifier's prompt and labels,
    which a generator other than the built-in one is asked. The provider's target is checked
    before any call. reference is the provider and model whose prices count; files
    is a folder for the summaries as Markdown or YAML. providers puts generators
    in the place of the built-in one; ledger is a folder for their answers, which
    later runs take from there. A dry run returns the sources that would be
    summarized; nothing is called or written.
    """
    options = {"generate": summarize.generator(provider, providers)} | options
    _refuse(spark, provider, model, target, allowed or {})
    rows = _new(spark, spark.read.parquet(transcripts), output, force)
    if dry_run:
        return rows.select("source")
    if ledger:
        options["ledger"] = Ledger(spark, ledger, provider, model)
    if bundle is not None:
        options = {"prompts": bundle.prompts, "routes": bundle.routes, "keywords": bundle.keywords} | options
        # A model that answers prompts tells the kind of meeting; the built-in generator can't.
        if bundle.classifier and bundle.labels and options["generate"] is not summarize.extractive:
            options = {"classify": options["generate"], "classifier": bundle.classifier, "labels": bundle.labels} | options
    found = summarize.summarize(rows.select(F.col("source").alias("doc_id"), "text", meta.prompt_context(F.col("source")).alias("context")), **options)
    pricing = tokens.pricing_summary(F.lit(provider), F.lit(model), F.lit(reference[0]), F.lit(reference[1]), F.col("input_tokens"), F.col("output_tokens"))
    found.withColumnRenamed("doc_id", "source").withColumn("pricing", pricing).write.mode("overwrite" if force else "append").parquet(output)
    table = spark.read.parquet(output)
    if files:
        base = F.replace(F.col("source"), F.lit(".txt"), F.lit(""))
        name = F.concat(base, F.lit(".summary.md" if form == "markdown" else ".summary.yaml"))
        writers.write_texts(table.select(name.alias("source"), writers.summary_text(base, F.col("summary"), form).alias("text")), files)
    return table


def chunk_files(spark: SparkSession, transcripts: str, output: str, style: str = "word", max_tokens: int = 3000, number: int = 1, keywords: list[str] = (), form: str = "json") -> None:
    """What a pass of summarizing would cut transcripts into, for inspection: as rows of JSON, or each chunk as a text."""
    rows = spark.read.parquet(transcripts)
    pieces = chunk.chunk_text(F.col("text"), style, max_tokens, keywords, chunk.pass_threshold(number))
    kind = route.classify_rules(F.col("text")).alias("meeting_type")
    (writers.write_chunk_texts if form == "text" else writers.write_chunks)(rows.select(F.col("source").alias("doc"), kind, F.lit(number).alias("pass"), F.posexplode(pieces).alias("part", "chunk")), output)


#: Buckets of an index by source.
BUCKETS = 64


def build_index(
    spark: SparkSession,
    transcripts: str,
    summaries: str | None,
    output: str,
    segments: DataFrame | None = None,
    embed: index.Embed = index.hashed_embedding,
    ids: DataFrame | None = None,
    finders: dict[str, index.Embed] | None = None,
    cells: int | None = None,
    names: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The index of transcripts and summaries, a versioned table in buckets of sources.

    Rows of an index that is there already are replaced source by source, and
    others stay; only buckets that new sources fall in are written, and the new
    version is there at once or not at all. cells asks for an inverted file
    beside it with so many coarse centroids, 0 for a number of its own choice;
    one that is there is kept up to date.
    """
    rows = index.index_transcripts(spark.read.parquet(transcripts), segments, ids, embed=embed, finders=finders, names=names)
    if summaries:
        files = spark.read.parquet(summaries).select(meta.summary_name(F.col("source")).alias("source"), F.col("summary").alias("text"))
        rows = rows.unionByName(index.index_summaries(files, ids, embed=embed), allowMissingColumns=True)
    rows = scratch.written(rows.withColumn("scope", F.concat_ws(":", "category", "source")), "index")
    table = versions.VersionedTable(spark, output)
    before = table.version()
    versions.upsert(table, rows, F.pmod(F.xxhash64("scope"), F.lit(BUCKETS)), scope="scope")
    held = inverted.InvertedFile(spark, f"{output}/cells")
    if held.table.version():
        held.add(rows.drop("scope"), table.tombstones(since=before))
    elif cells is not None:
        held.build(table.read().drop("scope", "bucket"), cells or None)
    return table.read().drop("scope", "bucket")


def index_texts(spark: SparkSession, transcripts: str, output: str) -> literal.LiteralIndex:
    """The trigram index of an index's transcripts, for literal search; search_index takes it where it is there."""
    files = spark.read.parquet(transcripts).select("source", F.lit(search.TRANSCRIPT).alias("category"), F.col("text").alias("document"))
    return literal.LiteralIndex(spark, f"{output}/texts").build(files)


def search_index(spark: SparkSession, path: str, transcripts: str, query: str, strategy: str = "hybrid", nprobe: int | None = None) -> DataFrame:
    """Ranked results of a query, its vector made by the built-in embedding with the query's instruction.

    Where the index has an inverted file it is searched: in the nprobe nearest
    cells, or, by default, in as many as exact results take.
    """
    vector = list(spark.range(1).select(index.embed_query(F.lit(query))).first()[0])
    cells = inverted.InvertedFile(spark, f"{path}/cells")
    near = None
    if cells.table.version():
        near = lambda n, category: cells.search(vector, n, nprobe or 8, category, exact=nprobe is None)
    if _exists(spark, f"{path}/texts/grams"):
        files = literal.LiteralIndex(spark, f"{path}/texts").search(query)
    else:
        files = spark.read.parquet(transcripts).select("source", F.lit(search.TRANSCRIPT).alias("category"), F.col("text").alias("document"))
    return search.search(versions.VersionedTable(spark, path).read(), files, query, vector, strategy, near=near)
