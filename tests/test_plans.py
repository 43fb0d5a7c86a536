import datetime

import pytest
from colloquy.operators import increment, index, route, search, segment, speakers, summarize
from colloquy.plans import config
from colloquy.sources import readers, writers
from colloquy.streaming import live
from pyspark.sql import functions as F


def test_name_variants_and_hotwords(spark):
    people = spark.createDataFrame([("council", "ann_lee_may", ["Annie", " "]), ("board", "cher", None), ("none", " ", ["x"])], "role string, person_key string, aliases array<string>")
    titles = spark.createDataFrame([("council", ["Alderman", "City Clerk"])], "role string, titles array<string>")
    got = {}
    for r in speakers.name_variants(people, titles).collect():
        got.setdefault(r.person, set()).add(r.variant)
    # The key is split at its first underscore only.
    names = {"Annie", "ann", "lee_may", "ann lee_may"}
    said = {f"{t} {n}" for t in ("Alderman", "City Clerk", "City Clerk Director") for n in ("lee_may", "ann lee_may")}
    assert got == {"ann_lee_may": names | said, "cher": {"cher"}}
    assert speakers.hotwords(people, titles).first()[0] == "Alderman, Annie, City Clerk, x"


def test_scan_is_by_whole_words(spark):
    chunks = spark.createDataFrame([(1, "Ann Lee spoke; annex."), (2, "the lee side"), (3, "")], "i int, text string")
    variants = spark.createDataFrame([("a", "ann"), ("a", "Ann Lee"), ("a", "lee"), ("b", "nex")], speakers.VARIANTS)
    got = sorted(map(tuple, speakers.scan_names(chunks, variants, ["i"]).collect()))
    assert got == [(1, "a", "Ann Lee"), (1, "a", "ann"), (1, "a", "lee"), (2, "a", "lee")]


def test_routes(spark):
    label = route.label_of(F.lit("I think CITY_COUNCIL, not council"), ["council", "city_council"])
    routes = {"general": {"first": "a", "multi": "b", "final": "c"}}
    row = spark.range(1).select(label.alias("l"), route.route_of(F.lit("x"), routes, final="z").alias("r")).first()
    assert row.l == "city_council" and tuple(row.r) == ("a", "b", "z")
    assert spark.range(1).select(route.missing_prompts(route.route_of(F.lit("x"), routes), ["a"])).first()[0] == ["b", "c"]


def test_index_aligns_upserts_and_finds_money(spark):
    said = "First we opened the meeting and everyone said hello to us. Then we paid $1,200.50 for 3 roofs and $5 million more."
    files = spark.createDataFrame([("AbCdEfGhIjK.council_2024-01-02.txt", said)], "source string, text string")
    ids = spark.createDataFrame([("abcdefghijk", "ABCDEFGHIJK")], "lower_id string, real_id string")
    segments = files.select("source", F.posexplode(F.split("text", r"(?<=\.) (?=T)")).alias("segment_index", "t")).select("source", "segment_index", (F.col("segment_index") * 10.0).alias("start_time"), index.hashed_embedding(F.col("t")).alias("embedding"))
    rows = index.index_transcripts(files, segments, ids, size=12, overlap=0).orderBy("chunk_index").collect()
    assert [(r.id[:10], r.ts, r.money, r.video_id, r.date, r.type) for r in rows] == [("TRANSCRIPT", 0.0, None, "ABCDEFGHIJK", "2024-01-02", "council"), ("TRANSCRIPT", 10.0, "$1,200.50, $5 million", "ABCDEFGHIJK", "2024-01-02", "council")]
    capitals = lambda t: F.regexp_extract_all(t, F.lit("[A-Z][a-z]+"), 0)
    named = index.index_transcripts(files, finders={"persons": capitals}).first()
    assert (named.persons, named.money) == ("First, Then", "$1,200.50, $5 million")
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    new = spark.createDataFrame([("2", "c"), ("3", "d"), ("3", "d")], "id string, v string")
    assert sorted(map(tuple, index.upsert(old, new).collect())) == [("1", "a"), ("2", "c"), ("3", "d")]


def test_summaries(spark):
    docs = spark.createDataFrame([(1, "One. Two. Three."), (2, "Budget item. " * 900), (3, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in summarize.summarize(docs, max_tokens=200).collect()}
    assert rows[1].summary == "One. Two." and rows[1].passes == 2 and rows[2].meeting_type == "finance_committee"
    assert all(r.total_tokens == r.input_tokens + r.output_tokens for r in rows.values())
    assert summarize.summarize(docs, max_tokens=200, max_pass=1).filter("passes <> 1").count() == 0
    with pytest.raises(ValueError):
        summarize.summarize(docs, max_pass=0)


def test_rows_of_one_id_are_documents_of_their_own(spark):
    docs = spark.createDataFrame([(1, "Left here. And there."), (1, "Right now. And then."), (None, "No id. At all."), (2, None)], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.summary) for r in summarize.summarize(docs, max_tokens=100).collect()), key=str)
    assert rows == sorted([(1, "Left here. And there."), (1, "Right now. And then."), (None, "No id. At all."), (2, "")], key=str)


def test_clean_names_are_all_different(spark):
    def cleaned(*names):
        rows = increment.clean_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()
        assert len({r.clean_name for r in rows}) == len(rows)
        return {r.name: r.clean_name for r in rows}

    assert cleaned("A.txt", "a.txt", "a_1.txt") == {"a.txt": "a.txt", "a_1.txt": "a_1.txt", "A.txt": "a_2.txt"}
    assert cleaned("B.mp3", "b!.mp3", "b?.mp3", "b_.mp3") == {"B.mp3": "b.mp3", "b_.mp3": "b_.mp3", "b!.mp3": "b__1.mp3", "b?.mp3": "b__2.mp3"}
    assert cleaned("X", "x", "X_1", "x_01") == {"x": "x", "X_1": "x_1", "X": "x_2", "x_01": "x_01"}
    folders = spark.createDataFrame([("f", "A"), ("f", "a"), ("g", "A")], "folder string, name string")
    assert {(r.folder, r.name): r.clean_name for r in increment.clean_names(folders, per=["folder"]).collect()} == {("f", "A"): "a_1", ("f", "a"): "a", ("g", "A"): "a"}


def test_stamps_handles_and_lines(spark, tmp_path):
    from colloquy.functions import text
    from colloquy.operators import segment

    stamps = spark.createDataFrame([(4.35,), (0.0,), (3661.5,), (59.999,), (360000.25,)], "s double").select(segment.vtt_stamp(F.col("s"))).collect()
    assert [r[0] for r in stamps] == ["00:00:04.349", "00:00:00.000", "01:01:01.500", "00:00:59.999", "100:00:00.250"]
    names = ["abc", " abc_1\n", "abc\nd", "a b", "", "Abc", "é"]
    assert [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(text.is_handle(F.col("n"))).collect()] == [True, True, False, False, False, False, False]
    (tmp_path / "ids").mkdir()
    for name, ids in (("b", "ABCDEFGHIJk\nlast_line_1\n"), ("a", "ABCDEFGHIJK\n"), ("c", "abcdefghijk\n")):
        (tmp_path / "ids" / name).write_text(ids)
    got = {r.lower_id: r.real_id for r in increment.id_map(readers.lines(spark, str(tmp_path / "ids"))).collect()}
    assert got == {"abcdefghijk": "abcdefghijk", "last_line_1": "last_line_1"}
    rows = spark.createDataFrame([("1", "a", 1), ("1", "c", 2), ("1", "b", 3)], "id string, v string, at int")
    assert {index.upsert(rows.limit(0), rows.repartition(n), order=["at"]).first().v for n in (1, 2, 3)} == {"b"}


def test_alignment_in_cells(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = {"a": (70, 110), "b": (1, 3), "c": (4, 0), "d": (0, 2)}
    chunks, segments, want = [], [], {}
    for key, (n, m) in sizes.items():
        left, right = np.round(rng.standard_normal((n, 3)), 1), np.round(rng.standard_normal((m, 3)), 1)
        left[:1], right[1:2] = 0, right[:1]  # a vector without direction, and a tie
        chunks += [(key, i, left[i].tolist()) for i in range(n)]
        segments += [(key, j, j * 10.0, right[j].tolist()) for j in range(m)]
        unit = lambda x: x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-10)
        if m:
            want |= {(key, i): 10.0 * int(j) for i, j in enumerate(np.round(unit(left) @ unit(right).T, 9).argmax(axis=1))}
    c = spark.createDataFrame(chunks, "source string, chunk_index int, embedding array<double>")
    s = spark.createDataFrame(segments, "source string, segment_index int, start_time double, embedding array<double>")
    for cell in (2048, 16):
        aligned = index.align(c, s, "source", cell=cell)
        assert {(r.source, r.chunk_index): r.ts for r in aligned.collect()} == want and aligned.schema["chunk_index"].dataType.simpleString() == "int"


def test_responses(spark):
    bodies = {
        "ollama": '{"response":"a"}\n\n{"response":"b"}\n{"done":true}',
        "openai": '{"output":[{"content":[{"text":"a"},{"text":"b"}]}]}',
        "anthropic": '{"content":[{"type":"text","text":"a"},{"type":"tool"},{"type":"text","text":"b"}]}',
        "llamacpp": '{"choices":[{"text":"ab"}]}',
        "codex_cli": " ab ",
    }
    assert summarize.generator(" OpenAI ") is summarize.extractive and summarize.generator("own", {"own": max}) is max
    for unknown in ("", "nobody"):
        with pytest.raises(ValueError):
            summarize.generator(unknown)
    for name, body in bodies.items():
        assert spark.range(1).select(summarize.response_text(name, F.lit(body))).first()[0] == "ab", name
    with pytest.raises(ValueError):
        summarize.response_text("other", F.lit(""))


def test_trackers_and_listings(spark, tmp_path):
    path = str(tmp_path / "tracker")
    assert increment.tracker_keys(readers.lines(spark, path)).count() == 0
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    writers.append_tracker(items.filter("key < 'c'"), path)
    done = increment.tracker_keys(readers.lines(spark, path))
    assert [r.key for r in increment.pending(items, done, "key").collect()] == ["c"]
    assert increment.pending(items, done, "key", force=True).count() == 3
    ids = increment.id_map(spark.createDataFrame([("AbCdEfGhIjK", 1), ("ABCDEFGHIJK", 2), ("short", 3)], "value string, line long"))
    assert [tuple(r) for r in ids.collect()] == [("abcdefghijk", "ABCDEFGHIJK")]
    listing = spark.createDataFrame([(0, "20240301"), (1, "20240215"), (2, "20240101"), (3, "20240220")], "position int, upload_date string")
    assert [r.position for r in increment.within_dates(listing, "20240201", "20240229").collect()] == [1]
    assert [r.position for r in increment.within_dates(listing.withColumn("c", F.lit(1)), "20240201", "20240229", per=["c"]).collect()] == [1]
    assert increment.within_dates(listing, "20230101", "20250101").count() == 4
    writers.write_listing(spark.createDataFrame([(100, "c", ["v"])], readers.LISTING), str(tmp_path / "l"))
    cache = readers.listings(spark, str(tmp_path / "l"))
    assert (increment.fresh_listing(cache, F.lit(86_500)).count(), increment.fresh_listing(cache, F.lit(86_501)).count()) == (1, 0)
    names = increment.clean_names(spark.createDataFrame([("A b.MP3",), ("a_b.mp3",), ("c",)], "name string")).collect()
    assert sorted(r.clean_name for r in names) == ["a_b.mp3", "a_b_1.mp3", "c"]


def test_files(spark, tmp_path):
    for name, body in {"b.txt": "two", "a.TXT": "one", "x.punct.txt": "p", "v.vtt": "WEBVTT\n\n00:01.000 --> 00:02.000\nHi\n", "m.council_2024-01-02.summary.md": "s"}.items():
        (tmp_path / name).write_text(body)
    at = str(tmp_path)
    assert [r.name for r in readers.discover(spark, at, [".txt"], "punct.txt").collect()] == ["a.TXT", "b.txt"]
    assert [r.name for r in readers.discover(spark, f"{at}/a.TXT", [".txt"]).collect()] == ["a.TXT"]
    with pytest.raises(FileNotFoundError):
        readers.discover(spark, f"{at}/none", [".txt"])
    with pytest.raises(ValueError):
        readers.discover(spark, f"{at}/v.vtt", [".txt"])
    assert sorted((r.source, r.text) for r in readers.texts(spark, at, ".txt", "punct.txt").collect()) == [("b.txt", "two")]
    assert [tuple(c) for c in readers.captions(spark, at).first().cues] == [(1.0, 2.0, "Hi")]
    assert [(r.label, r.date) for r in readers.summaries(spark, at).collect()] == [("Council | 2024-01-02", "2024-01-02")]
    assert len(readers.media(spark, at, [".vtt"]).first().sha256) == 64
    segs = spark.createDataFrame([("s", "v", [(0.0, 1.0, "a"), (1.0, 2.5, "b")])], "source string, video_id string, segments array<struct<start:double,end:double,text_raw:string>>")
    rows = segment.segment_rows(segs)
    writers.write_segments(rows, str(tmp_path / "seg"))
    back = readers.segments(spark, str(tmp_path / "seg"))
    assert sorted((r.id, r.duration, r.text_raw) for r in back.collect()) == [("s_00000", 1.0, "a"), ("s_00001", 1.5, "b")]
    assert readers.segments(spark, str(tmp_path / "seg"), with_embedding=True).count() == 0
    assert segs.select(writers.segment_text(F.col("segments"))).first()[0] == "a\n\nb\n\n"
    assert segs.select(writers.summary_text(F.lit("n"), F.lit("x\ny"), "yaml")).first()[0] == "summary: |-\n  x\n  y\n"
    writers.write_texts(spark.createDataFrame([("a/b", "line1\nline2")], "source string, text string"), str(tmp_path / "out"))
    assert next((tmp_path / "out" / "document=a_b").glob("part*")).read_text() == "line1\nline2\n"
    writers.write_chunks(spark.createDataFrame([("d", "t", 1, 0, "c")], "doc string, meeting_type string, pass int, part int, chunk string"), str(tmp_path / "ch"))
    assert (tmp_path / "ch/doc=d/meeting_type=t/pass=1").is_dir()
    assert spark.read.json(str(tmp_path / "ch")).first().file == "d_part01.txt"


def test_nominal_stitching(spark):
    rows = spark.createDataFrame([("d", 0, 0, 0.0, 5.0, "a"), ("d", 2, 0, 1.0, 2.0, "b")], "doc string, chunk long, idx long, start double, end double, text string")
    assert sorted(r.start for r in segment.stitch(rows).collect()) == [0.0, 6.0]
    assert sorted(r.start for r in segment.stitch(rows, 598.0).collect()) == [0.0, 1197.0]


def test_search_helpers(spark):
    assert search.confidence(spark.createDataFrame([(str(i), float(-i)) for i in range(5)], "id string, score double")).filter("confidence = 'High'").count() == 3


def test_config(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text(f'[system]\nroot_data_dir = "{tmp_path}"\nmodel = "s"\n\n[entities]\n')
    config.upsert_entity(str(path), "my_city_council", "My \"City\"", inputs=["youtube"])
    (tmp_path / "my_city_council").mkdir()
    (tmp_path / "my_city_council" / "config.toml").write_text('[settings]\nmodel = "l"\n[people.council]\nann_lee = ["Ann"]\n')
    got = config.resolve(str(path), "my_city_council")
    assert got["model"] == "l" and got["people"]["council"] == {"ann_lee": ["Ann"]} and got["display_name"] == 'My "City"' and got["inputs"] == ["youtube"]
    assert config.faults(config.load(str(path))) == []
    assert config.faults({"entities": {"x": {}}}) == ["system.root_data_dir is missing", "entity x: display_name is missing", "entity x: entity is missing"]
    assert "people" in config.scaffold({}, "my_city_council") and "people" not in config.scaffold({}, "pod")
    config.remove_entity(str(path), "my_city_council")
    for bad in (lambda: config.remove_entity(str(path), "no"), lambda: config.upsert_entity(str(path), "No!", "x"), lambda: config.load("/nowhere"), lambda: config.token_budget(9000, None, 8192), lambda: config.model_entry({"A": {}}, "b")):
        with pytest.raises(config.ConfigError):
            bad()
    assert config.token_budget(None, 750, 8192) == 1000 and config.model_entry({"A": {"x": 1}}, "a") == {"x": 1} and config.first_given(None, 0, 1) == 0
    assert config.prompt_bundle([str(tmp_path)], "civic").routes
    (tmp_path / "civic").mkdir()
    (tmp_path / "civic" / "prompts.toml").write_text('[prompts.a]\ntext = "x {text}"\n[prompt_router.general]\nfirst = "a"\nmulti = "a"\nfinal = "zz"\n')
    with pytest.raises(config.ConfigError, match="zz"):
        config.prompt_bundle([str(tmp_path)], "civic")


def test_documents_stream_once(spark, tmp_path):
    landed, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.createDataFrame([(1, "Hello  there. and so on. Next one.")], "doc_id long, text string").coalesce(1).write.parquet(landed)
    run = lambda: live.run_increment(live.documents(spark, landed), live.normalized, target, checkpoint).awaitTermination()
    run()
    spark.createDataFrame([(2, "Two.")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(landed)
    run()
    run()
    assert sorted((r.doc_id, r.sentences) for r in spark.read.parquet(target).collect()) == [(1, ["Hello there. and so on.", "Next one."]), (2, ["Two."])]


def test_live_cues(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    schema = "doc string, at timestamp, start double, end double, text string"
    rows = [("d", at, 0.0, 1.0, "Good"), ("d", at, 1.0, 2.0, "evening."), ("d", at, 2.0, 3.0, "left open"), ("e", at, 0.0, 100.0, "long")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "a"))
    query = live.live_segments(spark.readStream.schema(schema).parquet(str(tmp_path / "a"))).writeStream.format("memory").queryName("segs").outputMode("append").start()
    query.processAllAvailable()
    late = at + datetime.timedelta(hours=1)
    spark.createDataFrame([("f", late, 0.0, 1.0, "later.")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))
    query.processAllAvailable()
    spark.createDataFrame([("g", late + datetime.timedelta(hours=1), 0.0, 1.0, "last.")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))
    query.processAllAvailable()
    query.stop()
    assert {(r.doc, r.start, r.end, r.text_raw) for r in spark.table("segs").collect()} == {("d", 0.0, 2.0, "Good evening."), ("e", 0.0, 100.0, "long"), ("f", 0.0, 1.0, "later."), ("g", 0.0, 1.0, "last."), ("d", 2.0, 3.0, "left open")}


def test_event_windows_stream(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "e"))
    query = live.event_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))).writeStream.format("memory").queryName("counted").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("counted").agg(F.sum("n")).first()[0] == events.count()
