import math
import re
import time

import pytest
from colloquy.functions import meta, policy, text, tokens, vectors
from colloquy.operators import chunk, segment
from pyspark.sql import functions as F

EDGES = [
    "", "   ", "one", "été été", "the The the end", "a b  c ", "3.5 and $1,200 at 10:30", 'He said "go." Then left.', "no end", "lower start. Then Next? yes! \"Quoted\" x",
    "x (  y ) [Music] um, Uh (aside) erm done", "a\n\n\n\nb\r\nc", "one\x1ctwo \x1d three", "“q” — ‘r’ – s", "word , word ;word", "Jr. Smith. 3 of them.\n\nnext line. And more",
]


def both(spark, sf, column, rule, edges=EDGES):
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + edges
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "i int, text string")
    got = {r[0]: r[1] for r in df.select("i", column(F.col("text"))).collect()}
    for i, t in enumerate(docs):
        assert got[i] == rule(t), repr(t[:200])


def ws(t):
    return "\n".join(re.sub(r"\s+", " ", line).strip() for line in re.split(r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]", t)).strip()


def replaced(t, terms):
    for k in sorted(terms, key=len, reverse=True):
        t = re.sub(re.escape(k), lambda _: terms[k], t, flags=re.I)
    return t


def estimate(t):
    return max(1, len(re.sub(r"\s+", " ", t)) // 4)


def shown(t, q="the", n=350):
    at = t.lower().find(q)
    if at < 0:
        s = t[:n].strip() + ("..." if len(t) > n else "")
    else:
        a, b = max(0, at - n // 2), min(len(t), at + len(q) + n // 2)
        s = re.sub(re.escape(q), lambda m: f"**{m[0]}**", ("..." if a else "") + t[a:b] + ("..." if b < len(t) else ""), flags=re.I)
    return t[:n] + "..." if len(s) < 50 else s


@pytest.mark.parametrize(
    "column, rule",
    [
        (text.normalize_whitespace, ws),
        (lambda c: text.replace_terms(c, {"the": "t$1\\", "then": "x", "(": "["}), lambda t: replaced(t, {"the": "t$1\\", "then": "x", "(": "["})),
        (tokens.estimate, estimate),
        (lambda c: text.snippet(c, "the"), shown),
        (text.word_count, lambda t: len(t.split())),
        (text.read_minutes, lambda t: math.ceil(len(t.split()) / 230)),
    ],
    ids=["whitespace", "replace", "tokens", "snippet", "words", "minutes"],
)
def test_rules(spark, sf, column, rule):
    both(spark, sf, column, rule)


@pytest.mark.parametrize(
    "said, left",
    [
        ("the bill (as amended) passed", "the bill (as amended) passed"),
        ("thanks (Applause) all [MUSIC] of you", "thanks all of you"),
        ("um, so Uh we   erm\n\n\nleave", ", so we leave"),
        ("umbrella (music and noise) [noises]", "umbrella (music and noise) [noises]"),
        ("(laughter)", ""),
    ],
)
def test_deep_clean(spark, said, left):
    assert spark.createDataFrame([(said,)], "t string").select(text.deep_clean(F.col("t"))).first()[0] == left


def timed(spark, column, value):
    df = spark.createDataFrame([(value,)], "t string")
    began = time.time()
    got = df.select(column(F.col("t"))).first()[0]
    assert time.time() - began < 30
    return got


def test_long_rows_take_linear_time(spark):
    blanks = "a" + " " * 1_000_000 + "b"
    assert timed(spark, text.strip, " " * 100_000 + blanks + " " * 100_000) == blanks
    assert timed(spark, text.punctuation_spacing, blanks + " )") == blanks + ")"
    assert timed(spark, text.collapse_repeats, "go " + "the The " * 100_000 + "end") == "go the end"
    lines = ["Item one." if i % 3 == 0 else "and so on" for i in range(100_000)]
    df = spark.createDataFrame([(lines,)], "t array<string>")
    began = time.time()
    got = df.select(segment.merge_fragments(F.col("t"))).first()[0]
    assert got == ["Item one. and so on and so on"] * 33_333 + ["Item one."]
    sentences = " ".join(f"Item number {i} passed." for i in range(100_000))
    assert " ".join(timed(spark, lambda c: chunk.index_chunks(c, 150, 0), sentences)) == sentences
    assert timed(spark, lambda c: chunk.sentence_chunks(c, 200, 0), sentences)[-1].endswith("Item number 99999 passed.")
    assert time.time() - began < 60


@pytest.mark.parametrize(
    "said, clean",
    [
        ("", ""), ("   ", ""), ("one", "one"), ("été été", "été"), ("the The the end", "the end"), ("a b  c ", "a b  c"),
        ("3.5 and $1,200 at 10:30", "3. 5 and $1, 200 at 10: 30"), ("x (  y ) [Music] um, Uh (aside) erm done", "x (y) [Music] um, Uh (aside) erm done"),
        ("a\n\n\n\nb\r\nc", "a\n\nb\r\nc"), ("“q” — ‘r’ – s", "\"q\" - 'r' - s"), ("word , word ;word", "word, word; word"),
    ],
)
def test_patterns(spark, said, clean):
    assert spark.createDataFrame([(said,)], "t string").select(text.normalize_patterns(F.col("t"))).first()[0] == clean


def listed(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column(F.col("t"))).first()[0]


SAID = 'Dr. Lee came. then she left! "Why?" asked Bo. 3 went on?  no one did.'
DENSE = "the cat the sat on the mat. the dog ran off. a bird sang here. one more of them. and so it went on."
COUNTED = "One two three. Four five six seven. Eight. Nine ten eleven twelve. Last one here."


def test_splits_of_known_texts(spark):
    assert listed(spark, segment.sentences_strict, SAID) == ["Dr.", "Lee came. then she left!", '"Why?" asked Bo.', "3 went on?  no one did."]
    assert listed(spark, segment.sentences_loose, SAID) == ["Dr.", "Lee came.", "then she left!", '"Why?" asked Bo.', "3 went on?", "no one did."]
    assert listed(spark, segment.merge_fragments, ["A b", "c d", "E", "f", "g", "H"], "array<string>") == ["A b c d", "E f g", "H"]
    words = [f"w{i}" for i in range(20)]
    assert listed(spark, lambda c: chunk.word_chunks(c, 10), " ".join(words)) == [" ".join(words[i : i + 7]) for i in (0, 7, 14)]
    assert listed(spark, lambda c: chunk.word_chunks(c, 10), "a b") == ["a b"]
    assert listed(spark, lambda c: chunk.sentence_chunks(c, 8), COUNTED) == ["One two three. Four five six seven.", "Four five six seven. Eight.", "Eight. Nine ten eleven twelve.", "Nine ten eleven twelve. Last one here."]
    assert listed(spark, lambda c: chunk.index_chunks(c, 6, 2), COUNTED) == ["One two three.", "two three. Four five six seven.", "six seven. Eight.", "seven. Eight. Nine ten eleven twelve.", "eleven twelve. Last one here."]
    assert listed(spark, lambda c: chunk.index_chunks(c, 6, 0), COUNTED) == ["One two three.", "Four five six seven. Eight.", "Nine ten eleven twelve.", "Last one here."]
    assert [listed(spark, column, DENSE) for column in (lambda c: chunk.sentence_chunks(c, 12), lambda c: chunk.density_chunks(c, 12, ["the"], 1), lambda c: chunk.density_chunks(c, 12, ["the"], 3))] == [
        ["the cat the sat on the mat. the dog ran off.", "the dog ran off. a bird sang here. one more of them.", "one more of them. and so it went on."],
        ["the cat the sat on the mat.", "the cat the sat on the mat. the dog ran off.", "the dog ran off. a bird sang here. one more of them.", "one more of them. and so it went on."],
        ["the cat the sat on the mat.", "the cat the sat on the mat. the dog ran off.", "the dog ran off. a bird sang here. one more of them. and so it went on."],
    ]
    assert [listed(spark, column, DENSE) for column in (lambda c: chunk.sentence_chunks(c, 20), lambda c: chunk.density_chunks(c, 20, ["the"], 1), lambda c: chunk.density_chunks(c, 20, ["the"], 3))] == [
        ["the cat the sat on the mat. the dog ran off. a bird sang here. one more of them.", "one more of them. and so it went on."],
        ["the cat the sat on the mat.", "the cat the sat on the mat. the dog ran off.", "the dog ran off. a bird sang here. one more of them. and so it went on."],
        ["the cat the sat on the mat. the dog ran off. a bird sang here.", "a bird sang here. one more of them. and so it went on."],
    ]


def of_documents(spark, sf, column):
    """(text, list) for the documents and the edge cases."""
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + EDGES
    df = spark.createDataFrame(list(enumerate(docs)), "i int, text string")
    return [(docs[r[0]], r[1]) for r in df.select("i", column(F.col("text"))).collect()]


def test_sentences_lose_nothing(spark, sf):
    bare = lambda *parts: "".join("".join(p.split()) for p in parts)
    for t, found in of_documents(spark, sf, segment.sentences_strict):
        assert bare(*found) == bare(t) and all(s[-1] in ".!?" for s in found[:-1]) and all(re.match("[A-Z0-9\"']", s) for s in found[1:])
    for t, found in of_documents(spark, sf, segment.sentences_loose):
        assert bare(*found) == bare(t) and all(s[-1] in ".!?" for s in found[:-1]) and not any(re.search(r"[.?!]\s", s) for s in found)
    for t, found in of_documents(spark, sf, lambda c: segment.merge_fragments(segment.sentences_strict(c))):
        assert bare(*found) == bare(t) and not any(s[0].islower() for s in found[1:])


def test_word_chunks_overlap_and_lose_nothing(spark, sf):
    for t, found in of_documents(spark, sf, lambda c: chunk.word_chunks(c, 60)):
        if len(t.split()) <= 45:
            assert found == [t]
            continue
        parts = [c.split() for c in found]
        assert all(len(p) == 45 for p in parts[:-1]) and all(a[-4:] == b[:4] for a, b in zip(parts, parts[1:]))
        assert parts[0] + [w for p in parts[1:] for w in p[4:]] == t.split()


@pytest.mark.parametrize("dense", [False, True])
def test_sentence_chunks_are_runs_of_sentences(spark, sf, dense):
    column = (lambda c: F.struct(chunk.density_chunks(c, 90, ["the", "of"], 3), segment.sentences_loose(c))) if dense else (lambda c: F.struct(chunk.sentence_chunks(c, 90), segment.sentences_loose(c)))
    for t, (found, sentences) in of_documents(spark, sf, column):
        if estimate(t) <= 90:
            assert found == [t]
            continue
        whole = " ".join(sentences)
        assert all(c in whole for c in found) and whole.startswith(found[0]) and whole.endswith(found[-1])
        assert all(any(s in c for c in found) for s in sentences)
        # Nothing is said less often than the text says it, and the overlap is a tenth or a sentence.
        assert sum(map(len, found)) >= len(whole) - len(found)
        if not dense:
            most = max(map(estimate, sentences))
            assert all(estimate(c) <= 90 + most + c.count(" ") for c in found)


@pytest.mark.parametrize("overlap", [12, 0])
def test_index_chunks_keep_size_and_overlap(spark, sf, overlap):
    column = lambda c: F.struct(chunk.index_chunks(c, 40, overlap), segment.sentences_loose(c))
    for t, (found, sentences) in of_documents(spark, sf, column):
        longest = max((len(s.split()) for s in sentences), default=0)
        parts = [c.split() for c in found]
        said = []
        for p in parts:
            own = p if not said or not overlap else p[min(overlap, len(last)) :]
            assert len(p) <= max(40, longest + overlap)
            said, last = said + own, p
        assert said == t.split()


def test_consolidation(spark):
    sets = [
        [(0.0, 3.0, "Good evening"), (3.0, 6.5, "everyone.\n Welcome"), (6.5, 9.0, "to the 'meeting.'"), (9.0, 9.5, " "), (100.0, 101.0, "After a gap")],
        [(0.0, 95.0, "long one"), (95.0, 200.0, "and on"), (200.0, 201.0, "end?\"")],
        [(0.0, 1.0, "")], [], [(0.0, 1.0, "a. "), (1.0, 2.0, "b"), (2.0, 3.0, "c!")],
    ]
    whole = [(0.0, 9.0, "Good evening everyone. Welcome to the 'meeting.'"), (9.0, 101.0, "After a gap")]
    three, short = [(0.0, 95.0, "long one"), (95.0, 200.0, "and on"), (200.0, 201.0, 'end?"')], [(0.0, 1.0, "a."), (1.0, 3.0, "b c!")]
    want = {
        (90.0, 1): [whole, three, [], [], short],
        (90.0, 3): [whole, [(0.0, 200.0, "long one and on")], [], [], [(0.0, 3.0, "a. b c!")]],
        (5.0, 1): [[(0.0, 6.5, "Good evening everyone. Welcome"), (6.5, 9.0, "to the 'meeting.'"), (9.0, 101.0, "After a gap")], three, [], [], short],
    }
    df = spark.createDataFrame(list(enumerate(sets)), "i int, cues array<struct<start:double,end:double,text:string>>")
    for (window, least), segments in want.items():
        for r in df.select("i", segment.consolidate(F.col("cues"), window, least).alias("s")).collect():
            assert [tuple(x) for x in r.s] == segments[r.i]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_captions(spark):
    vtt = "WEBVTT\r\n\r\n1\r\n00:01.500 --> 01:00:02.250 align:left\r\n<v Ann>Hello  there\r\nyou\r\n\r\n00:00:03.000 --> 00:00:04.000\r\n \r\n"
    got = one(spark, segment.parse_vtt(F.lit(vtt)))[0]
    assert [tuple(c) for c in got] == [(1.5, 3602.25, "Hello there\nyou")]
    assert one(spark, segment.vtt_stamp(F.lit(3661.9999)))[0] == "01:01:01.999"
    with pytest.raises(Exception, match="not a timestamp"):
        one(spark, segment.vtt_seconds(F.lit("12")))


def test_file_names(spark):
    names = ["AbCdEfGhIjK.city_council_2024-3-7.txt", "x.finance_1_2_24.punct.txt", "notes.txt", "o'neil.3rd_ward-10-11-2023.summary.md", "budget.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    label, date = meta.label_and_date(F.col("n"))
    rows = df.select(meta.document_type(F.col("n")), meta.file_date(F.col("n")), meta.file_id(F.col("n")), label, date, meta.prompt_context(F.col("n"))).collect()
    assert [tuple(r)[:3] for r in rows] == [("council", "2024-3-7", "AbCdEfGhIjK"), ("finance", "1-2-24", None), ("general", "unknown", None), ("general", "10-11-2023", None), ("finance", "unknown", None)]
    assert [tuple(r)[3:5] for r in rows] == [("City Council | 2024-03-07", "2024-03-07"), ("Finance | 2024-01-02", "2024-01-02"), ("Notes | 0000-00-00", "0000-00-00"), ("3Rd Ward | 2023-10-11", "2023-10-11"), ("Budget | 0000-00-00", "0000-00-00")]
    assert [r[5] for r in rows][1:3] == ["Finance - 2024-01-02", "Txt"]


def test_policy_and_costs(spark):
    fault = lambda p, t, **k: one(spark, policy.target_fault(F.lit(p), F.lit(t), **k))[0]
    assert fault("ollama", "http://localhost:1", allow_http=True) is None
    assert fault("ollama", "http://10.0.0.1", allow_http=True) == "off-box"
    assert fault("openai", "https://api.x.com", allow_remote=True) is None
    assert fault("codex_cli", "my tool", allow_executable=True) == "unsafe executable"
    assert fault("codex_cli", "/bin/tool", allow_executable=True) is None
    assert one(spark, policy.model_fault(F.lit(" ")), policy.model_fault(F.lit("a\nb")), policy.model_fault(F.lit("m"))) == ("model missing", "control characters", None)
    price = tokens.pricing_summary(F.lit("ollama"), F.lit("m"), F.lit("anthropic"), F.lit("claude-haiku-9"), F.lit(10**6), F.lit(10**6))
    assert one(spark, price.alias("p")).p.estimated_cost == 6.0
    assert one(spark, tokens.cost(F.lit("ollama"), F.lit("m"), F.lit(5), F.lit(5)))[0] is None


def test_numbers_can_be_protected(spark):
    t = F.lit("at 10:30 for $1,200 ,ok:yes")
    assert one(spark, text.punctuation_spacing(t), text.punctuation_spacing(t, True)) == ("at 10: 30 for $1, 200, ok: yes", "at 10:30 for $1,200, ok: yes")


def test_prompts(spark):
    t = "{{x}} {context}|{text}"
    assert one(spark, text.render_prompt(t, F.lit("T")), text.render_prompt(t, F.lit("T"), F.lit("C"))) == ("{x} No context provided.|T", "{x} C|T")
    assert one(spark, text.safe_path_part(F.lit(" a/b\\c ")), text.safe_path_part(F.lit(" .. ")))[:] == ("a_b_c", None)


def test_hashed_embeddings_by_their_rule(spark):
    import hashlib
    import math

    texts = ["The the CAT, été_1 x-y", "", " .. ", None, "q" * 50, "İstanbul ÉTÉ 😀 ² Ⅷ"] + [f"w{i} w{i % 7} and" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    words = F.filter(F.split(F.lower("t"), r"(?U)\W+"), lambda w: w != "")
    rows = df.select("t", words.alias("w"), vectors.hashed_embedding(F.col("t")).alias("e")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if r.t is None:
            assert r.e is None
            continue
        sums = [0] * 64
        for w in r.w:
            code = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 128
            sums[code % 64] += 1 if code < 64 else -1
        norm = math.sqrt(sum(x * x for x in sums))
        assert r.e == pytest.approx([x / norm if norm else 0.0 for x in sums], rel=1e-6)


def test_white_space_around_goes_without_a_pattern(spark):
    blanks = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    rows = [blanks + "a" + blanks + "b" + blanks, blanks, "", "a\u200b", "\u180ea"]
    df = spark.createDataFrame([(r,) for r in rows], "t string").select(text.strip(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == ["a" + blanks + "b", "", "", "a\u200b", "\u180ea"]
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
    plan = spark.range(1).select(text.normalize_patterns(text.normalize_whitespace(F.col("id").cast("string"))))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan


def test_chunks_split_at_any_white_space(spark):
    said = "One two.\u00a0 Three\n\nfour?\tFive.six !\u2028 . Seven"
    df = spark.createDataFrame([(said,), ("",), (" \n",)], "t string").select(chunk.index_chunks(F.col("t"), 3, 0).alias("c"))
    assert [r.c for r in df.collect()] == [["One two.", "Three four?", "Five.six ! .", "Seven"], [], []]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("(?U)") == 1
