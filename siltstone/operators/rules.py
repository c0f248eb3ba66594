"""Threshold rules over the quality signals, in the order they are asked."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

REJECTION = "struct<reason:string,signal:string,value:double,threshold:double>"


class Rule(NamedTuple):
    signal: str
    kind: str  # 'min' and 'max' pass at the threshold; 'false' wants no True
    threshold: float
    reason: str


#: Fixed values.
RULES = [
    Rule("num_characters", "min", 50, "too_few_characters"),
    Rule("num_words", "min", 30, "too_few_words"),
    Rule("num_lines", "min", 10, "too_few_lines"),
    Rule("num_lines", "max", 100_000, "too_many_lines"),
    Rule("num_bytes", "max", 3_000_000, "file_too_large"),
    Rule("mean_word_length", "min", 2.0, "mean_word_too_short"),
    Rule("mean_word_length", "max", 10.0, "mean_word_too_long"),
    Rule("max_line_length", "max", 1000, "line_too_long"),
    Rule("mean_line_length", "min", 5.0, "mean_line_too_short"),
    Rule("mean_line_length", "max", 100.0, "mean_line_too_long"),
    Rule("replacement_character_fraction", "max", 0.01, "too_many_replacement_characters"),
    Rule("duplicate_line_fraction", "max", 0.70, "too_many_duplicate_lines"),
    Rule("top_2gram_fraction", "max", 0.20, "repetitive_2grams"),
    Rule("top_3gram_fraction", "max", 0.18, "repetitive_3grams"),
    Rule("top_4gram_fraction", "max", 0.16, "repetitive_4grams"),
    Rule("alphabetic_fraction", "min", 0.25, "too_little_alphabetic_content"),
    Rule("numeric_fraction", "max", 0.20, "too_much_numeric_content"),
    Rule("whitespace_fraction", "max", 0.50, "too_much_whitespace"),
    Rule("comment_fraction", "max", 0.80, "too_many_comments"),
    Rule("encoded_data_fraction", "max", 0.40, "too_much_encoded_data"),
    Rule("long_string_fraction", "max", 0.40, "too_much_long_string_data"),
    Rule("parse_error", "false", 0.0, "parse_error"),
]
#: Rules that only suit code; the profile for prose leaves them out.
CODE_ONLY = {"too_few_lines", "line_too_long", "mean_line_too_long"}
PROSE_RULES = [r for r in RULES if r.reason not in CODE_ONLY]


def rejection(reason: str, signal: str, value: Column, threshold: float) -> Column:
    return F.struct(F.lit(reason).alias("reason"), F.lit(signal).alias("signal"), value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"))


def first_rejection(signals: Column, rules: list[Rule] = RULES) -> Column:
    """The first rule a document breaks, as a struct; null where it keeps all. A null signal breaks none."""
    out = F.lit(None).cast(REJECTION)
    for rule in reversed(rules):
        value = signals[rule.signal]
        broken = value if rule.kind == "false" else value < rule.threshold if rule.kind == "min" else value > rule.threshold
        out = F.when(broken, rejection(rule.reason, rule.signal, value, rule.threshold)).otherwise(out)
    return out
