"""Source files that do not parse: one verdict per file, rates per repository and language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import parsers
from siltstone.functions.signals import PARSED_LANGUAGES, Parser
from siltstone.llm.arrow import map_rows
from siltstone.llm.grammars import language

VERDICT = "verdict string, error_line int, error_token string"


def verdict(label: str | None, text: str | None) -> tuple[str, int | None, str | None]:
    """('valid' | 'failing' | 'truncated' | 'blank' | 'unsupported', line, token).

    blank: null or only white space. unsupported: no grammar for the label.
    failing: the token at which the derivative is empty; truncated: the text ends
    where no sentence may end. Labels are compared in lower case without blanks.
    """
    if text is None or not text.strip():
        return "blank", None, None
    checker = language(label.strip().lower()) if label else None
    if checker is None:
        return "unsupported", None, None
    found = checker.check(text)
    return ("valid", None, None) if found is None else (found[0], found[1], found[2][:80])


def core_parser() -> Parser:
    """These grammars as the plug-in of the core's quality filter, for every language it asks a parser for."""

    def check(label: str):
        return lambda text: verdict(label, text)[0] in ("failing", "truncated")

    return parsers.parser({label: check(label) for label in PARSED_LANGUAGES if label != "python"})


def check_files(files: DataFrame, keep: list[str], text: str = "content", label: str = "language") -> DataFrame:
    """The columns of keep with verdict, error_line and error_token of each row."""
    types = dict(files.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [VERDICT])

    def make():
        def work(texts, labels, *kept):
            return [(*k, *verdict(lab, t)) for t, lab, *k in zip(texts, labels, *kept, strict=True)]

        return work

    return map_rows(files, [text, label, *keep], schema, make)


def is_invalid(verdict: Column) -> Column:
    return verdict.isin("failing", "truncated")


def rates(checked: DataFrame, by: str) -> DataFrame:
    """Per value of by: files with text in a known language, and how many do not parse.

    Values with no such file have a null rate. Null values form a group.
    """
    bad = F.count_if(is_invalid(F.col("verdict")))
    known = F.count_if(~F.col("verdict").isin("blank", "unsupported"))
    return checked.groupBy(by).agg(known.alias("n_files"), bad.alias("n_invalid"), F.when(known > 0, bad / known).alias("invalid_share"))
