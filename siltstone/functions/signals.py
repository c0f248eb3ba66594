"""The 20 quality signals of a source document.

Text signals are JVM expressions. Comment and string shares come from a lexical
scan of the language. Whether a text parses is asked of a pluggable parser; with
none, parse_error is null and no document is rejected for it.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from siltstone.functions import text as T
from siltstone.session import ensure_importable

#: Languages with a syntax known to the parser interface, in lower case (fixed values).
PARSED_LANGUAGES = ["c", "c#", "c++", "dart", "go", "java", "javascript", "kotlin", "php", "python", "ruby", "rust", "scala", "swift", "typescript"]

#: Code points that Python counts as digits besides the decimal ones (fixed values).
EXTRA_DIGITS = r"²³¹፩-፱᧚⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"

#: A parser: languages (lower case) and texts in, True where the text has a syntax error, None where it cannot tell.
Parser = Callable[[list[str], list[str]], list[bool | None]]

#: Possessive groups, as the JVM matches them in a loop, however long a text is.
_DOUBLE = r'"[^"\\\n]*(?:\\.[^"\\\n]*)*+"'
_SINGLE = r"'[^'\\\n]*(?:\\.[^'\\\n]*)*+'"
_BACK = r"`[^`]*`"
_BLOCK = r"/\*[^*]*\*+(?:[^/*][^*]*\*+)*+/"
_TRIPLE = r'"""[^"]*(?:"{1,2}[^"]+)*+"""' + r"|'''[^']*(?:'{1,2}[^']+)*+'''"
_C = rf"//[^\n]*|{_BLOCK}|{_DOUBLE}|{_SINGLE}"
#: Comments and strings of each language, in the order a scan meets them.
LEXEMES = {
    "python": rf"{_TRIPLE}|#[^\n]*|{_DOUBLE}|{_SINGLE}",
    "ruby": rf"#[^\n]*|{_DOUBLE}|{_SINGLE}",
    "php": rf"//[^\n]*|#[^\n]*|{_BLOCK}|{_DOUBLE}|{_SINGLE}",
    "javascript": rf"{_C}|{_BACK}",
    "typescript": rf"{_C}|{_BACK}",
    "go": rf"{_C}|{_BACK}",
    "rust": rf"//[^\n]*|{_BLOCK}|{_DOUBLE}",
}
COMMON_LEXEMES = _C
_COMMENT_START = r"^(//|/\*|#)"
LONG_STRING_BYTES = 100


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _total_length(parts: Column, length: Callable[[Column], Column] = F.length) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, x: a + length(x))


def _ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")


def top_ngram_fraction(items: Column, size: int) -> Column:
    """Count of the most frequent run of size tokens, times size, per token; 0.0 below size tokens.

    The runs of a document are sorted and counted within its row, so no shuffle is needed
    and a document of any length stays one row.
    """
    ordered = F.sort_array(T.windows(items, size))
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(a["last"] == x, a["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["most"], run).alias("most"))

    most = F.aggregate(ordered, start, step, lambda a: a["most"])
    return F.when(F.size(items) >= size, (most * size).cast("double") / F.size(items).cast("double")).otherwise(0.0)


def lexemes(text: Column, language: Column) -> Column:
    """Comments and strings of a text in their order; null for other languages."""
    out = F.when(language.isin([x for x in PARSED_LANGUAGES if x not in LEXEMES]), F.regexp_extract_all(text, F.lit(COMMON_LEXEMES), F.lit(0)))
    for name, pattern in LEXEMES.items():
        out = out.when(language == name, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return out


def parse_errors(parser: Parser) -> Callable[[Column, Column], Column]:
    """The parser as an Arrow function of language and text."""

    @F.pandas_udf(BooleanType())
    def run(language: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series(parser(language.fillna("").tolist(), text.fillna("").tolist()), dtype="object")

    return run


def with_signals(documents: DataFrame, parser: Parser | None = None, content: str = "content", language: str = "language", name: str = "quality_signals") -> DataFrame:
    """documents with the struct of signals; a null text has a null struct.

    An existing column of that name is replaced.
    """
    if parser:
        ensure_importable(documents.sparkSession)
    text, label = F.col(content), F.lower(F.coalesce(F.col(language), F.lit("")))
    base = documents.drop(name).withColumn("_tokens", T.tokens(text)).withColumn("_lines", T.lines(text)).withColumn("_words", T.words(text))
    base = base.withColumn("_lexemes", lexemes(text, label)).withColumn("_full", F.filter(F.transform("_lines", T.strip), lambda x: x != ""))
    n = F.length(text)
    known = label.isin(PARSED_LANGUAGES)
    part = lambda keep, size: F.coalesce(_total_length(F.filter("_lexemes", keep), size), F.lit(0))
    comment = part(lambda x: x.rlike(_COMMENT_START), F.octet_length)
    long_string = part(lambda x: ~x.rlike(_COMMENT_START) & (F.octet_length(x) >= LONG_STRING_BYTES), F.octet_length)
    error = F.when(known, parse_errors(parser)(label, text)).otherwise(False) if parser else F.when(~known, False)
    signals = F.struct(
        n.alias("num_characters"),
        F.octet_length(text).alias("num_bytes"),
        F.size("_words").alias("num_words"),
        F.size("_lines").alias("num_lines"),
        _ratio(_total_length(F.col("_words")), F.size("_words")).alias("mean_word_length"),
        F.coalesce(F.array_max(F.transform("_lines", F.length)), F.lit(0)).alias("max_line_length"),
        _ratio(_total_length(F.col("_lines")), F.size("_lines")).alias("mean_line_length"),
        _ratio(n - F.length(F.replace(text, F.lit("�"), F.lit(""))), n).alias("replacement_character_fraction"),
        _ratio(F.size("_full") - F.size(F.array_distinct("_full")), F.size("_full")).alias("duplicate_line_fraction"),
        *[top_ngram_fraction(F.col("_tokens"), k).alias(f"top_{k}gram_fraction") for k in (2, 3, 4)],
        _ratio(_count(text, r"\p{L}"), n).alias("alphabetic_fraction"),
        _ratio(_count(text, rf"[\p{{Nd}}{EXTRA_DIGITS}]"), n).alias("numeric_fraction"),
        _ratio(_count(text, T.WS), n).alias("whitespace_fraction"),
        _ratio(_total_length(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9+/]{100,}={0,2}"), F.lit(0))), n).alias("encoded_data_fraction"),
        known.alias("parse_supported"),
        error.alias("parse_error"),
        F.when(known, _ratio(comment, F.octet_length(text))).otherwise(0.0).alias("comment_fraction"),
        F.when(known, _ratio(long_string, F.octet_length(text))).otherwise(0.0).alias("long_string_fraction"),
    )
    return base.withColumn(name, F.when(text.isNotNull(), signals)).drop("_tokens", "_lines", "_words", "_lexemes", "_full")
