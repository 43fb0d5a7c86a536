"""Cleanup, statistics and snippets of text columns.

Patterns carry (?U) so that white space, words and letters are Unicode's.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A white-space character, to be put in patterns with (?U): Unicode's and the four separators U+001C to U+001F.
WS, NOT_WS = r"[\s\x1C-\x1F]", r"[^\s\x1C-\x1F]"
SPACE = rf"(?U){WS}+"
#: The first of a run of white space. Patterns begin with it, so that most characters are passed by one test.
FIRST_WS = rf"{WS}(?<!{WS}{WS})"
#: All white space, one by one.
BLANKS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: What ends a line.
LINE_BREAK = r"\r\n|[\n\x0B\x0C\r\x1C-\x1E\x85\u2028\u2029]"
#: Notes of sounds in captions, and fillers.
SOUNDS, FILLERS = "music|applause|laughter|noise", "um|uh|erm"


def let(value: Column, body) -> Column:
    """body of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(text: Column) -> Column:
    """Without white space of any kind around; in time linear in the text, blanks within it included."""
    return F.btrim(text, F.lit(BLANKS))


def clean_lines(text: Column) -> Column:
    """White space collapsed and stripped within each line; line breaks stay."""
    lines = F.transform(F.split(text, LINE_BREAK), lambda line: strip(F.regexp_replace(line, SPACE, " ")))
    return F.array_join(lines, "\n")


def normalize_whitespace(text: Column) -> Column:
    return strip(clean_lines(text))


def plain_quotes(text: Column) -> Column:
    """Typographic quotes and dashes as ASCII ones."""
    for typed, plain in zip("“”’‘—–", "\"\"''--"):
        text = F.replace(text, F.lit(typed), F.lit(plain))
    return text


def punctuation_spacing(text: Column, protect_numbers: bool = False) -> Column:
    """No space before punctuation and one behind it; none inside parentheses.

    protect_numbers leaves marks between digits alone, as in 3.5 or 10:30.
    """
    text = F.regexp_replace(text, rf"(?U){FIRST_WS}{WS}*+([,.;:!?])", "$1")
    behind = rf"(?U)(?<!\d(?=[,.:]\d))([,.;:!?])({NOT_WS})" if protect_numbers else rf"(?U)([,.;:!?])({NOT_WS})"
    text = F.regexp_replace(text, behind, "$1 $2")
    return F.regexp_replace(F.regexp_replace(text, rf"(?U)\({WS}+", "("), rf"(?U){FIRST_WS}{WS}*+\)", ")")


def collapse_repeats(text: Column) -> Column:
    """A word said several times in a row is kept once, in its first spelling.

    The quantifiers give nothing back, so the matcher loops and doesn't recurse
    however often a word is repeated.
    """
    return F.regexp_replace(text, rf"(?Ui)\b(\w++)(?:{WS}++\1\b)++", "$1")


def limit_blank_lines(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def normalize_patterns(text: Column, protect_numbers: bool = False) -> Column:
    """All of the cleanups of spoken text, in their order."""
    return limit_blank_lines(collapse_repeats(punctuation_spacing(plain_quotes(text), protect_numbers)))


def replace_terms(text: Column, terms: dict[str, str]) -> Column:
    """Literal replacements regardless of case, longest term first; later ones see the results of earlier ones."""
    for term in sorted(terms, key=len, reverse=True):
        if term:
            value = terms[term].replace("\\", "\\\\").replace("$", "\\$")
            text = F.regexp_replace(text, r"(?Ui)\Q" + term.replace("\\E", "\\E\\\\E\\Q") + r"\E", value)
    return text


def deep_clean(text: Column) -> Column:
    """Without sound notes in brackets or parentheses and without fillers; runs of white space are one space.

    Other words in parentheses stay.
    """
    for opened, closed in (("\\[", "\\]"), ("\\(", "\\)")):
        text = F.regexp_replace(text, rf"(?Ui){opened}(?:{SOUNDS}){closed}", "")
    text = F.regexp_replace(text, rf"(?Ui)\b(?:{FILLERS})\b", "")
    return strip(F.regexp_replace(text, rf"(?U){WS}{{2,}}", " "))


def words(text: Column) -> Column:
    """White-space words as an array."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def read_minutes(text: Column, per_minute: int = 230) -> Column:
    return F.ceil(word_count(text) / F.lit(float(per_minute))).cast("long")


def dollar_signs(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("$"), F.lit("")))).cast("long")


def contains_literal(text: Column, query: str) -> Column:
    return F.contains(F.lower(text), F.lit(query.lower()))


def highlight(text: Column, query: str, max_chars: int = 300) -> Column:
    """The surroundings of the first hit with all hits marked by **; the head of the text without a hit."""
    half, n = max_chars // 2, F.length(text)
    at = F.locate(query.lower(), F.lower(text)) - 1
    start, stop = F.greatest(F.lit(0), at - half), F.least(n, at + len(query) + half)
    piece = F.substring(text, start + 1, stop - start)
    piece = F.concat(F.when(start > 0, "...").otherwise(""), piece, F.when(stop < n, "...").otherwise(""))
    marked = F.regexp_replace(piece, r"(?Ui)\Q" + query.replace("\\E", "\\E\\\\E\\Q") + r"\E", "**$0**")
    head = F.concat(strip(F.substring(text, 1, max_chars)), F.when(n > max_chars, "...").otherwise(""))
    return F.when(at >= 0, marked).otherwise(head)


def snippet(text: Column, query: str, max_chars: int = 350, min_chars: int = 50) -> Column:
    """highlight(), or the head of the text where that is too short to show."""
    marked = highlight(text, query, max_chars)
    return F.when(F.length(marked) < min_chars, F.concat(F.substring(text, 1, max_chars), F.lit("..."))).otherwise(marked)


def render_prompt(template: str, text: Column, context: Column | None = None) -> Column:
    """A template's {text} and {context}; doubled braces stand for single ones."""
    blank = F.lit("No context provided.")
    context = blank if context is None else F.when(F.coalesce(context, F.lit("")) == "", blank).otherwise(context)
    parts = []
    for piece in re.split(r"(\{text\}|\{context\})", template.replace("{{", "\0").replace("}}", "\1")):
        value = {"{text}": text, "{context}": context}.get(piece)
        parts.append(F.lit(piece.replace("\0", "{").replace("\1", "}")) if value is None else value)
    return F.concat(*parts)


def excerpt(text: Column, chars: int = 2000) -> Column:
    return F.substring(text, 1, chars)


def clean_file_name(name: Column) -> Column:
    """Lower case, and only letters, digits, dots, dashes and single underscores."""
    name = F.regexp_replace(F.lower(name), "[\"'‘’“”⧸]", "_")
    name = F.regexp_replace(name, "[^a-z0-9._-]", "_")
    return F.regexp_replace(F.regexp_replace(name, "_-_", "_"), "__+", "_")


def comma_list(text: Column) -> Column:
    """Trimmed, lower-cased, non-blank items of a comma-separated list."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.lower(strip(x))), lambda x: x != "")


def is_handle(text: Column) -> Column:
    """Whether a name, less the white space around it, has lower-case letters, digits and underscores only."""
    return strip(text).rlike(r"^[a-z0-9_]+\z")


def safe_path_part(text: Column) -> Column:
    """One component of a path: stripped of blanks, then of dots, slashes as underscores, no NUL; null where nothing is left."""
    safe = F.replace(F.translate(F.btrim(strip(text), F.lit(".")), "/\\", "__"), F.lit("\0"), F.lit(""))
    return F.when(~safe.isin("", ".", ".."), safe)
