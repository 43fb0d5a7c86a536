"""Chunks of a document, as folds over index ranges; the text is joined once, at the end.

Every function gives array<string>; a null text gives null, a blank one the
chunks that its rule gives it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import tokens
from ..functions.text import WS, let, words
from .segment import sentences_loose

RANGES = "array<struct<a:int,b:int>>"


def _range(a: Column, b: Column) -> Column:
    return F.array(F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")))


def _joined(items: Column, ranges: Column) -> Column:
    return F.transform(ranges, lambda r: F.array_join(F.slice(items, r["a"] + 1, r["b"] - r["a"]), " "))


def word_chunks(text: Column, max_tokens: int, overlap_tokens: int | None = None) -> Column:
    """Windows of 0.75 words per token, overlapping by a tenth or as given; a short text stays as it is."""
    size = int(max_tokens * 0.75)
    overlap = min(int(size * 0.1), 600) if overlap_tokens is None else int(overlap_tokens * 0.75)
    step = size - overlap
    if size < 1 or step < 1:
        raise ValueError("the overlap has to be shorter than the window")

    def cut(w):
        last = F.ceil((F.size(w) - size) / F.lit(float(step))).cast("int")
        windows = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(w, i * step + 1, size), " "))
        return F.when(F.size(w) <= size, F.array(text)).otherwise(windows)

    return let(words(text), cut)


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """Times that keywords stand alone in a text."""
    listed = [k for k in keywords if k]
    if not listed:
        return F.lit(0).cast("long")
    pattern = r"(?Ui)(?<!\w)(" + "|".join(r"\Q" + k + r"\E" for k in listed) + r")(?!\w)"
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _sentence_chunks(text: Column, max_tokens: int, overlap_tokens: int | None, keywords: list[str], limit) -> Column:
    """Sentences as long as limit(density so far) allows; a chunk opens with the tail of the one before.

    The state is where the chunk began and its tokens and hits; a tail is found
    by walking back from the chunk's end, so every sentence is looked at a
    bounded number of times.
    """

    def fold(v):
        n = F.size(v["s"])
        zero = F.lit(0).cast("long")
        init = F.struct(F.lit(0).alias("lo"), zero.alias("ct"), zero.alias("ad"), F.array().cast(RANGES).alias("out"))

        def take(acc, i):
            tk, dn = F.get(v["tk"], i), F.get(v["dn"], i)
            over = (acc["ct"] + tk > limit(acc["ad"] + dn)) & (i > acc["lo"])
            wanted = F.least((acc["ct"] * F.lit(0.1)).cast("int"), F.lit(600)) if overlap_tokens is None else F.lit(int(overlap_tokens))

            def back(tail, j):
                more = F.struct(j.alias("lo"), (tail["ct"] + F.get(v["tk"], j)).alias("ct"), (tail["ad"] + F.get(v["dn"], j)).alias("ad"))
                return F.when((tail["lo"] < i) & (tail["ct"] >= wanted), tail).otherwise(more)

            # The shortest tail, of one sentence at least, that has the tokens wanted.
            tail = F.aggregate(F.sequence(i - 1, F.least(acc["lo"], i - 1), F.lit(-1)), F.struct(i.alias("lo"), zero.alias("ct"), zero.alias("ad")), back)

            def opened(t):
                return F.struct(t["lo"].alias("lo"), (t["ct"] + tk).alias("ct"), (t["ad"] + dn).alias("ad"), F.concat(acc["out"], _range(acc["lo"], i)).alias("out"))

            grown = F.struct(acc["lo"].alias("lo"), (acc["ct"] + tk).alias("ct"), (acc["ad"] + dn).alias("ad"), acc["out"].alias("out"))
            return F.when(over, let(tail, opened)).otherwise(grown)

        ranges = F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), init, take, lambda a: F.concat(a["out"], _range(a["lo"], n)))
        return F.when(n > 0, _joined(v["s"], ranges)).otherwise(F.array().cast("array<string>"))

    def measured(s):
        return F.struct(s.alias("s"), F.transform(s, tokens.estimate).alias("tk"), F.transform(s, lambda x: keyword_hits(x, keywords)).alias("dn"))

    folded = let(sentences_loose(text), lambda s: let(measured(s), fold))
    return F.when(tokens.estimate(text) <= max_tokens, F.array(text)).otherwise(folded)


def sentence_chunks(text: Column, max_tokens: int, overlap_tokens: int | None = None) -> Column:
    """Whole sentences up to a token budget, overlapping by a tenth."""
    return _sentence_chunks(text, max_tokens, overlap_tokens, [], lambda density: F.lit(max_tokens))


def density_chunks(
    text: Column, max_tokens: int, keywords: list[str], threshold: float, exponent: float = 1.0, overlap_tokens: int | None = None, cap_scale: float | None = None
) -> Column:
    """As sentence_chunks, but smaller where keywords are dense and larger where they are rare.

    The budget is scaled by (threshold / density) ** exponent, a tenth at
    least; cap_scale bounds it above, which by default nothing does.
    """

    def limit(density):
        scale = F.greatest(F.pow(F.lit(float(threshold)) / density, F.lit(float(exponent))), F.lit(0.1))
        if cap_scale is not None:
            scale = F.least(scale, F.lit(float(cap_scale)))
        return F.greatest(F.lit(1), (F.lit(float(max_tokens)) * F.when(density == 0, F.lit(1.0)).otherwise(scale)).cast("long"))

    return _sentence_chunks(text, max_tokens, overlap_tokens, keywords, limit)


def pass_threshold(number: int) -> int:
    """Density threshold of a pass."""
    return [25, 75, 500][min(number - 1, 2)]


def chunk_text(text: Column, style: str, max_tokens: int, keywords: list[str] = (), threshold: float = 25) -> Column:
    """Chunks in a style: density, sentence or else word."""
    if style == "density":
        return density_chunks(text, max_tokens, list(keywords), threshold)
    return sentence_chunks(text, max_tokens) if style == "sentence" else word_chunks(text, max_tokens)


def index_chunks(text: Column, size: int = 150, overlap: int = 25) -> Column:
    """Sentences up to so many words; a chunk opens with the last words of the one before.

    A chunk shorter than the overlap is carried whole; without overlap nothing is.
    """

    def fold(v):
        n = F.size(v["w"])
        zero = F.lit(0).cast("long")
        init = F.struct(zero.alias("lo"), zero.alias("at"), F.array().cast(RANGES).alias("out"))

        def take(acc, count):
            at, after = acc["at"], acc["at"] + count
            out = F.when(at > acc["lo"], F.concat(acc["out"], _range(acc["lo"], at))).otherwise(acc["out"])
            lo = at if overlap == 0 else F.when(at - acc["lo"] >= overlap, at - overlap).otherwise(acc["lo"])
            cut = F.struct(lo.cast("long").alias("lo"), after.alias("at"), out.alias("out"))
            return F.when(after - acc["lo"] > size, cut).otherwise(F.struct(acc["lo"].alias("lo"), after.alias("at"), acc["out"].alias("out")))

        ranges = F.aggregate(v["counts"], init, take, lambda a: F.concat(a["out"], _range(a["lo"], n)))
        return F.when(n > 0, _joined(v["w"], ranges)).otherwise(F.array().cast("array<string>"))

    def measured(split):
        return F.struct(F.flatten(split).alias("w"), F.transform(split, lambda x: F.size(x).cast("long")).alias("counts"))

    # Words and sentences are told by one pattern over the text; what is split then are single characters.
    spaced = F.regexp_replace(text, rf"(?U){WS}+", " ")
    for mark in ".?!":
        spaced = F.replace(spaced, F.lit(f"{mark} "), F.lit(f"{mark}\n"))
    split = F.transform(F.split(spaced, "\n"), lambda sentence: F.filter(F.split(sentence, " "), lambda w: w != ""))
    return let(F.filter(split, lambda x: F.size(x) > 0), lambda split: let(measured(split), fold))
