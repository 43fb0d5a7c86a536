import pytest
from colloquy import cli
from colloquy.functions import register
from colloquy.operators import index, ledger, summarize
from colloquy.plans import config, stages
from colloquy.sources import readers, writers
from pyspark.sql import functions as F

VTT = "WEBVTT\n\n00:00.000 --> 00:04.000\nThe council met today\n\n00:04.000 --> 00:09.000\nto approve the budget. and more\n\n00:09.000 --> 00:12.000\nThank you all.\n"


def test_from_captions_to_search(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    for folder in ("vtt", "txt"):
        (tmp_path / folder).mkdir()
    (tmp_path / "vtt" / "AbCdEfGhIjK.council_2024-01-02.vtt").write_text(VTT)
    (tmp_path / "txt" / "AbCdEfGhIjK.council_2024-01-02.txt").write_text("The council met  today , um to approve the budget. and more. Thank you all.")
    ids = spark.createDataFrame([("abcdefghijk", "ABCDEFGHIJK")], "lower_id string, real_id string")
    for dry in (stages.slice_captions(spark, at("vtt"), at("seg"), dry_run=True), stages.normalize_texts(spark, at("txt"), at("norm"), dry_run=True)):
        assert dry.columns == ["source"] and dry.count() == 1
    assert not (tmp_path / "seg").exists() and not (tmp_path / "norm").exists()
    rows = stages.slice_captions(spark, at("vtt"), at("seg"), ids).collect()
    assert [(r.start_time, r.end_time, r.video_id) for r in rows] == [(0.0, 12.0, "ABCDEFGHIJK")]
    assert stages.slice_captions(spark, at("vtt"), at("seg"), ids).count() == 1
    lines = stages.normalize_texts(spark, at("txt"), at("norm"), {"budget": "Budget"}, deep=True).first().text
    assert lines == "The council met today, to approve the Budget. and more.\nThank you all.\n"
    assert stages.normalize_texts(spark, at("txt"), at("norm")).count() == 1
    by_and = lambda t: F.split(t, "(?<=\\.) (?=T)")
    assert stages.normalize_texts(spark, at("txt"), at("norm3"), split=by_and).first().text.count("\n") == 2
    assert stages.summarize_texts(spark, at("norm"), at("sum"), dry_run=True).columns == ["source"] and not (tmp_path / "sum").exists()
    loud = stages.summarize_texts(spark, at("norm"), at("sum3"), providers={"ollama": lambda prompt, text: F.upper(text)}, max_tokens=100).first()
    assert loud.summary.startswith("THE COUNCIL MET TODAY")
    assert stages.summarize_texts(spark, at("norm"), at("sum"), max_tokens=100).first().meeting_type == "finance_committee"
    first = {r.id: r for r in stages.build_index(spark, at("norm"), at("sum"), at("idx")).collect()}
    assert {r.category for r in first.values()} == {"raw_transcript", "summary"}
    # A second run replaces rows by id and keeps the others.
    spark.createDataFrame([("other.txt", "Something else. And more.")], "source string, text string").write.parquet(at("norm2"))
    again = {r.id: r for r in stages.build_index(spark, at("norm2"), None, at("idx")).collect()}
    assert set(first) < set(again) and all(again[k] == first[k] for k in first)
    found = stages.search_index(spark, at("idx"), at("norm"), "budget").collect()
    assert found and "**Budget**" in found[0].snippet
    # An inverted file and a trigram index beside it change no result, and follow it.
    stages.build_index(spark, at("norm2"), None, at("idx"), cells=2)
    stages.index_texts(spark, at("norm"), at("idx"))
    assert stages.search_index(spark, at("idx"), at("norm"), "budget").collect() == found
    spark.createDataFrame([("other.txt", "A zebra came. And more.")], "source string, text string").write.parquet(at("norm4"))
    stages.build_index(spark, at("norm4"), None, at("idx"))
    shown = stages.search_index(spark, at("idx"), at("norm"), "zebra").collect()
    assert shown == stages.search_index(spark, at("idx"), at("norm"), "zebra", nprobe=2).collect() and "zebra" in shown[0].snippet
    register.register(spark)
    register.register_index(spark, "near", at("idx"))
    v = spark.range(1).select(index.embed_query(F.lit("zebra")).cast("array<double>").alias("v"))
    v.createOrReplaceTempView("asked")
    assert spark.sql("SELECT f.id FROM asked, LATERAL near(v) AS f ORDER BY f.similarity DESC, f.id").first().id == shown[0].id


def test_summaries_with_bundles_prices_and_files(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    spark.createDataFrame([("a.txt", "The budget was read. It was long. " * 60)], "source string, text string").write.parquet(at("norm"))
    (tmp_path / "p" / "civic").mkdir(parents=True)
    (tmp_path / "p" / "civic" / "prompts.toml").write_text('[density_keywords]\nkeywords = ["budget"]\n[prompts.one]\ntext = "{text}"\n[prompt_router]\ngeneral = { first = "one", multi = "one", final = "one" }\n')
    bundle = config.prompt_bundle([at("none"), at("p")], "civic")
    row = stages.summarize_texts(spark, at("norm"), at("sum"), bundle=bundle, reference=("anthropic", "claude-haiku"), files=at("files"), style="density", max_tokens=100).first()
    assert row.pricing.reference_model == "claude-haiku" and abs(row.pricing.estimated_cost - (row.input_tokens + 5 * row.output_tokens) / 1e6) < 1e-12
    assert next((tmp_path / "files" / "document=a.summary.md").glob("part*")).read_text().startswith("# Summary: a\n\nThe budget was read.")
    for wrong in ({"target": "https://far.example.com"}, {"model": " "}, {"provider": "nobody"}):
        with pytest.raises(ValueError):
            stages.summarize_texts(spark, at("norm"), at("sum2"), **wrong)
    answered = summarize.summarize(spark.createDataFrame([(1, "x")], "doc_id int, text string"), classify=lambda prompt, text: F.concat(prompt, F.lit(" is City_Council")), classifier="{text}").first()
    assert answered.meeting_type == "city_council"
    stages.chunk_files(spark, at("norm"), at("chunks"), "sentence", 100)
    assert spark.read.json(at("chunks")).count() > 1


CIVIC = """
[prompt_router]
city_council = { first = "notes", multi = "shorter", final = "minutes" }
finance_committee = { first = "money", multi = "shorter", final = "minutes" }
general = { first = "notes", multi = "shorter", final = "minutes" }
[classifier_types]
allowed = ["city_council", "finance_committee", "general"]
[classifier_prompt]
text = '''
Which kind is it? {context}
{text}
'''
[density_keywords]
keywords = [
    # votes
    "motion", "vote",
]
[prompts.notes]
text = "NOTES {text}"
[prompts.money]
text = "MONEY {text}"
[prompts.shorter]
text = "SHORTER {text}"
[prompts.minutes]
text = "MINUTES {text}"
"""


def test_bundles_in_their_files_layout(spark, tmp_path, capsys):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "p" / "civic").mkdir(parents=True)
    (tmp_path / "p" / "civic" / "prompts.toml").write_text(CIVIC)
    bundle = config.prompt_bundle([at("p")], "civic")
    assert bundle.labels == ["city_council", "finance_committee", "general"] and bundle.keywords == ["motion", "vote"] and bundle.classifier.strip().startswith("Which kind")
    assert bundle.routes["finance_committee"]["first"] == "money" and set(bundle.prompts) == {"notes", "money", "shorter", "minutes"}
    texts = [("a.txt", "The budget hearing. Aye."), ("b.txt", "Zoning came up."), ("c.txt", "The council met. Aye.")]
    spark.createDataFrame(texts, "source string, text string").write.parquet(at("norm"))
    ruled = {r.source: r for r in stages.summarize_texts(spark, at("norm"), at("sum"), bundle=bundle).collect()}
    assert {k: r.meeting_type for k, r in ruled.items()} == {"a.txt": "finance_committee", "b.txt": "general", "c.txt": "city_council"}
    # A model is asked by the bundle's prompt, and may answer with its labels only; prompts can be put in the place of routes'.
    said = lambda prompt, text: F.when(prompt.startswith("Which kind"), F.lit("I say CITY_COUNCIL or zoning_committee")).otherwise(prompt)
    asked = {r.source: r for r in stages.summarize_texts(spark, at("norm"), at("sum2"), bundle=bundle, providers={"ollama": said}, final="money").collect()}
    assert {r.meeting_type for r in asked.values()} == {"city_council"} and asked["b.txt"].summary.startswith("MONEY SHORTER NOTES Zoning")
    with pytest.raises(ValueError):
        stages.summarize_texts(spark, at("norm"), at("sum3"), bundle=bundle, multi="unheard-of")
    assert cli.main(["intel", "run", "x", "y", "--print-prompts", "--prompts", at("p")]) == 0 and "SHORTER {text}" in capsys.readouterr().out
    assert cli.main(["intel", "run", at("norm"), at("sum4"), "--prompts", at("p"), "--final-prompt", "money"]) == 0
    for wrong in (CIVIC.replace("[prompts.notes]\ntext", "[prompts.notes]\nsaid"), CIVIC.replace('final = "minutes" }\ngeneral', 'final = "none" }\ngeneral'), CIVIC.replace("general = {", "other = {"), CIVIC.replace('"motion", "vote",', "1,"), "prompt_router = 3"):
        (tmp_path / "p" / "civic" / "prompts.toml").write_text(wrong)
        with pytest.raises(config.ConfigError):
            config.prompt_bundle([at("p")], "civic")


def counting(folder, fail=None):
    """A model that leaves a file for each call, and breaks down at one prompt as long as a file says so."""

    def call(prompt):
        import os
        import uuid

        if fail and fail in prompt and os.path.exists(f"{folder}/broken"):
            raise OSError("gone")
        with open(f"{folder}/call-{uuid.uuid4().hex}", "w") as f:
            f.write(prompt)
        return prompt.upper()

    return call


def calls(folder):
    return sorted(p.read_text() for p in folder.glob("call-*"))


def test_no_call_is_paid_for_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "TASK", 2)
    folder = tmp_path / "calls"
    folder.mkdir()
    prompts = [f"prompt {i:02d}" for i in range(20)] + ["prompt 03", None, ""]
    rows = spark.createDataFrame([(i, p, "t") for i, p in enumerate(prompts)], "n long, prompt string, chunk string")
    book = ledger.Ledger(spark, str(tmp_path / "ledger"), "ollama", "m")
    model = ledger.limited(counting(str(folder), "prompt 07"), retries=1, wait=0.01)
    (folder / "broken").touch()
    with pytest.raises(Exception, match="no answer after 2 calls"):
        book.ask(rows, model).collect()
    before = calls(folder)
    # What other tasks were answered is kept, though the job failed.
    kept = book.answers().count()
    assert 0 < kept < 21 and "prompt 07" not in before
    (folder / "broken").unlink()
    got = {r.n: r.said for r in book.ask(rows, model).collect()}
    assert got == {i: None if p is None else p.upper() for i, p in enumerate(prompts)}
    after = calls(folder)
    assert set(after) == {p for p in prompts if p is not None} and len(after) - len(set(after)) <= len(before) - kept
    assert {r.n: r.said for r in book.ask(rows, model).collect()} == got and calls(folder) == after
    other = ledger.Ledger(spark, str(tmp_path / "ledger"), "ollama", "m2")
    other.ask(rows.limit(1), model).collect()
    assert len(calls(folder)) == len(after) + 1


def test_summaries_with_a_ledger(spark, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    docs = spark.createDataFrame([(1, "One. Two."), (1, "Other. Words."), (None, "Third. Text."), (None, None)], "doc_id long, text string")
    book = ledger.Ledger(spark, str(tmp_path / "ledger"), "own", "m")
    model = ledger.limited(counting(str(folder)))
    first = sorted(map(str, summarize.summarize(docs, model, ledger=book).collect()))
    n = len(calls(folder))
    assert n == len(set(calls(folder))) and sorted(map(str, summarize.summarize(docs, model, ledger=book).collect())) == first and len(calls(folder)) == n


def test_captions_are_read_in_splits(spark, tmp_path):
    cues = [(round(2 * i + 0.25, 3), round(2 * i + 1.5, 3), f"Line {i} of it.\nAnd more" if i % 3 else f"Line {i}") for i in range(4000)]
    stamp = lambda s: f"{int(s // 3600):02}:{int(s // 60) % 60:02}:{s % 60:06.3f}"
    body = "WEBVTT\n\n" + "\n\n".join(f"{i}\n{stamp(a)} --> {stamp(b)}\n{t}" for i, (a, b, t) in enumerate(cues)) + "\n"
    (tmp_path / "long.VTT").write_text(body)
    (tmp_path / "dos.vtt").write_bytes(body.replace("\n", "\r\n").encode())
    (tmp_path / "gaps.vtt").write_text("WEBVTT\n\n\n\n00:01.000 --> 00:02.000\n\nfirst\n \n00:03.000 --> 00:04.000\nsecond\n\n\n")
    (tmp_path / "notes.txt").write_text("00:01.000 --> 00:02.000\nno")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = readers.cue_rows(spark, str(tmp_path))
        split = rows.filter("source = 'long'").groupBy(F.spark_partition_id()).count().count()
        got = {r.source: r.cues for r in readers.gathered(rows).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert split > 3
    whole = {r.source: r.cues for r in readers.captions(spark, str(tmp_path)).collect()}
    assert set(whole) == {"long", "dos", "gaps"} and got == {k: v for k, v in whole.items() if v} and len(got["long"]) == 4000
    assert readers.cue_rows(spark, str(tmp_path), since="2100-01-01 00:00:00").count() == 0
    stream = readers.cue_rows(spark, str(tmp_path), stream=True).drop("place")
    query = stream.writeStream.format("memory").queryName("cues_of_files").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("cues_of_files").filter("source = 'long'").count() == 4000
    for wrong, error in ((str(tmp_path / "none"), FileNotFoundError), (str(tmp_path / "notes.txt"), ValueError)):
        with pytest.raises(error):
            readers.cue_rows(spark, wrong)
        with pytest.raises(error):
            readers.captions(spark, wrong)


def test_captions_stream_into_the_index(spark, tmp_path):
    from colloquy.sources import versions
    from colloquy.streaming import live

    at = lambda n: str(tmp_path / n)
    (tmp_path / "in").mkdir()
    run = lambda: live.index_captions(spark, at("in"), at("cues"), at("idx"), at("check")).awaitTermination(120)
    rows = lambda: {r.id: (r.document, r.ts) for r in versions.VersionedTable(spark, at("idx")).read().collect()}
    (tmp_path / "in" / "a.vtt").write_text(VTT)
    (tmp_path / "in" / "b.vtt").write_text("WEBVTT\n\n00:01.000 --> 00:02.000\nAnother one.\n")
    run()
    first = rows()
    assert set(first) == {"TRANSCRIPT_a_0", "TRANSCRIPT_b_0"} and first["TRANSCRIPT_a_0"][0].endswith("The council met today to approve the budget. and more Thank you all.")
    # The last batch is replayed, as after a crash before its commit.
    commits = sorted(p for p in (tmp_path / "check" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "check" / "commits").glob(f"*{commits[-1].name}*"):
        p.unlink()
    before = versions.VersionedTable(spark, at("idx")).version()
    run()
    assert versions.VersionedTable(spark, at("idx")).version() > before and rows() == first
    # A late cue goes to its place, one that comes again replaces the first, and b stays.
    (tmp_path / "in" / "a.VTT").write_text("WEBVTT\n\n00:04.000 --> 00:09.000\nto refuse the budget. and more\n\n00:12.000 --> 00:13.000\nGood night.\n")
    run()
    last = rows()
    assert last["TRANSCRIPT_b_0"] == first["TRANSCRIPT_b_0"] and len(last) == 2
    assert last["TRANSCRIPT_a_0"][0].endswith("The council met today to refuse the budget. and more Thank you all. Good night.")
    run()
    assert rows() == last


def test_chunks_as_texts_and_names_of_chunks(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A.TXT").write_text("The council met. " * 300)
    assert stages.normalize_texts(spark, at("in"), at("norm")).count() == 1
    stages.chunk_files(spark, at("norm"), at("chunks"), "word", 200, form="text")
    files = sorted((tmp_path / "chunks" / "meeting_type=city_council" / "pass=1").glob("file=A.TXT_part*.txt"))
    assert len(files) > 3 and files[0].name.endswith("_part01.txt") and next(files[0].glob("part*")).read_text().startswith("The council met.")
    said = spark.createDataFrame([("a.txt", "Then Ann Lee rose and said that Bob and the Water Board had not paid for it. " * 30), ("b.txt", "Ann Lee.")], "source string, text string")
    people = spark.createDataFrame([("ann_lee", "Ann"), ("ann_lee", "Ann Lee"), ("bob", "bob"), ("cy", "Cy")], "person string, variant string")
    boards = spark.createDataFrame([("Water Board", "water board")], "person string, variant string")
    rows = index.index_transcripts(said, names={"persons": people, "orgs": boards}).collect()
    assert {(r.source, r.persons, r.orgs) for r in rows} == {("a.txt", "ann_lee, bob", "Water Board"), ("b.txt", None, None)}


def test_uploads_and_trackers(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    writers.write_listing(spark.createDataFrame([(100, "c", ["v1", "v2", "v3", "v4"]), (-10**6, "old", ["v9"])], readers.LISTING), at("cache"))
    dates = spark.createDataFrame([("v1", "20240301"), ("v2", "20240215"), ("v3", "20230101"), ("v4", "20240220"), ("v9", "20240220")], "video_id string, upload_date string")
    todo = lambda: sorted(r.video_id for r in stages.pending_uploads(spark, at("cache"), dates, at("done"), 200, "20240101", "20241231").collect())
    assert todo() == ["v1", "v2"]
    writers.append_tracker(spark.createDataFrame([("v1",)], "key string"), at("done"))
    assert todo() == ["v2"]
    (tmp_path / "vtt").mkdir()
    (tmp_path / "vtt" / "AbCdEfGhIjK.x.vtt").write_text(VTT)
    (tmp_path / "ids").write_text("ABCDEFGHIJK\nshort\n")
    rows = stages.slice_captions(spark, at("vtt"), at("seg"), stages.id_map(spark, at("ids")), texts=at("texts"), tracker=at("sliced")).collect()
    assert {r.video_id for r in rows} == {"ABCDEFGHIJK"}
    assert next((tmp_path / "texts" / "document=AbCdEfGhIjK.x").glob("part*")).read_text().endswith("Thank you all.\n\n")
    assert [r.value for r in readers.lines(spark, at("sliced")).collect()] == ["AbCdEfGhIjK.x"]


def test_command_line(spark, tmp_path, capsys):
    path = tmp_path / "c.toml"
    path.write_text(f'[system]\nroot_data_dir = "{tmp_path}"\n')
    run = lambda *a: cli.main(["--config", str(path), *a])
    assert run("config", "add", "my_city_council", "--display-name", "My City", "--inputs", " YouTube, ,x") == 0
    assert run("config", "init", "my_city_council") == 0 and (tmp_path / "my_city_council" / "config.toml").exists()
    assert run("config", "validate") == 0 and run("config", "list") == 0 and run("config", "resolve", "my_city_council") == 0
    assert "youtube" in capsys.readouterr().out
    assert run("config", "inspect", "my_city_council") == 0
    assert '"file_count": 1' in capsys.readouterr().out
    writers.write_listing(spark.createDataFrame([(100, "c", ["v1", "v2"])], readers.LISTING), str(tmp_path / "my_city_council" / "listing"))
    assert run("source", "fetch", "my_city_council", "--source", "YouTube") == 0 and "2 rows" in capsys.readouterr().out
    # x is declared and has no adapter.
    assert run("source", "fetch", "my_city_council") == 1
    settings = config.resolve(str(path), "my_city_council")
    own = {"x": lambda s, _: s.createDataFrame([("d", "w1", 0)], "channel string, video_id string, position int")}
    assert sorted(r.video_id for r in stages.fetch_sources(spark, settings, adapters=own).collect()) == ["v1", "v2", "w1"]
    with pytest.raises(config.ConfigError):
        config.wanted_sources({"entity": "e", "inputs": [" "]})
    assert run("config", "purge", "my_city_council") == 0 and (tmp_path / "my_city_council").exists()
    assert run("config", "purge", "my_city_council", "--yes") == 0 and not (tmp_path / "my_city_council").exists()
    assert run("config", "remove", "my_city_council") == 1
    assert run("intel", "run", "x", "y", "--print-prompts") == 0
    (tmp_path / "txt").mkdir()
    (tmp_path / "txt" / "a.txt").write_text("One. Two.")
    assert run("transcript", "normalize", str(tmp_path / "txt"), str(tmp_path / "norm")) == 0
    assert run("intel", "run", "x", "y", "--max-tokens", "9000") == 1


def test_sql_functions(spark):
    assert "cosine" in register.register(spark)
    row = spark.sql("SELECT token_estimate('a  b c d e f g'), sentences_of('One. Two?  Three'), words_of(' a b '), round(cosine(array(1D, 0D), array(1D, 1D)), 4), placeholder_id('x')").first()
    rows = spark.sql("SELECT d.n, f.i, f.sentence FROM VALUES (1, 'One. Two? Three.'), (2, ''), (3, NULL) AS d(n, t), LATERAL strict_sentences(d.t) AS f").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "One."), (1, 1, "Two?"), (1, 2, "Three.")]
    assert row[0] == 3 and row[1] == ["One.", "Two?", "Three"] and row[2] == ["a", "b"] and row[3] == 0.7071 and len(row[4]) == 11
