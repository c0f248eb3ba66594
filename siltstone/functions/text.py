"""Text functions with the meaning of Python's str methods and re, as JVM expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes: words, white space and line ends as Python takes them (fixed values).
WORD_CHAR = r"[\p{L}\p{N}_]"
WS_SET = r"\p{IsWhite_Space}\x1c-\x1f"
WS = rf"[{WS_SET}]"
WORD = rf"{WORD_CHAR}+"
TOKEN = rf"{WORD_CHAR}+|[^\p{{L}}\p{{N}}_{WS_SET}]"
LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]"
SHINGLE_TOKENS = 5


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WS}+|{WS}+\z", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"{WS}+\z", "")


def normalize(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"{WS}+", " "))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def tokens(text: Column) -> Column:
    """Words and single signs; the empty list for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def token_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{WS_SET}]+")), F.lit(0))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once per row, wherever and how often it is used."""
    return F.transform(F.array(value), use)[0]


def windows(items: Column, size: int) -> Column:
    """Runs of size items joined by blanks; the empty list where there are fewer items."""

    def runs(own: Column) -> Column:
        count = F.size(own) - (size - 1)
        made = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(own, i, size)))
        return F.when(count >= 1, made).otherwise(F.array().cast("array<string>"))

    return let(items, runs)


def shingles(items: Column, size: int = SHINGLE_TOKENS) -> Column:
    """Distinct runs of size tokens; fewer tokens are one run, no tokens the empty run."""
    return let(items, lambda own: F.array_distinct(F.when(F.size(own) < size, F.array(F.concat_ws(" ", own))).otherwise(windows(own, size))))


def lines(text: Column) -> Column:
    """Lines without their ends; a final line end adds no line, and neither does the empty text."""
    return let(F.split(text, LINE_END, -1), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def fenced_block(text: Column, language: str) -> Column:
    """Inside of the first fenced block of a language (or without one), else the text; stripped."""
    pattern = rf"(?s)```(?i:{language})?{WS}*(.*?)```"
    return strip(F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(text))


def unwrap_fence(text: Column) -> Column:
    """Inside of a text that is one fenced block, else the text as it is."""
    pattern = rf"(?s)\A{WS}*```[^\n]*\n(.*?)\n```{WS}*\z"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(text)
