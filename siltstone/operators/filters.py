"""Screening: text checks, then quality rules; the first failure names the rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.functions.signals import Parser, with_signals
from siltstone.operators.rules import RULES, Rule, first_rejection, rejection

#: Directories of third-party copies and marks of generated files and of secrets (fixed values).
VENDOR_DIRECTORIES = ["vendor", "node_modules", "third_party", "third-party"]
GENERATED = r"(?iuU)generated by|do not edit|auto-generated|webpack|protobuf compiler"
_B = rf"{T.WS}*"
SECRET = rf"(?iu)(?:api[_-]?key|secret|password|token){_B}[:=]{_B}['\"][^'\"]{{8,}}['\"]|AKIA[0-9A-Z]{{16}}"


def is_malformed(text: Column) -> Column:
    """Null, blank, or with a NUL character."""
    return text.isNull() | ~text.rlike(rf"[^{T.WS_SET}]") | text.contains("\x00")


def path_parts(*columns: Column) -> Column:
    """Lower-case parts of the first path that is neither null nor empty."""
    first = F.coalesce(*[F.when(c != "", c) for c in columns], F.lit(""))
    return F.split(F.lower(F.replace(first, F.lit("\\"), F.lit("/"))), "/")


def is_vendor(documents: DataFrame) -> Column:
    """The flag is true, or a part of the path is a third-party folder; absent columns say nothing."""
    paths = [F.col(c) for c in ("file_path", "path", "repo_path") if c in documents.columns]
    flag = F.coalesce(F.col("is_vendor").cast("boolean"), F.lit(False)) if "is_vendor" in documents.columns else F.lit(False)
    inside = F.arrays_overlap(path_parts(*paths), F.array(*map(F.lit, VENDOR_DIRECTORIES))) if paths else F.lit(False)
    return flag | inside


def is_generated(text: Column) -> Column:
    return F.coalesce(text.rlike(GENERATED), F.lit(False))


def has_secret(text: Column) -> Column:
    return F.coalesce(text.rlike(SECRET), F.lit(False))


def text_rejection(documents: DataFrame, content: str = "content") -> Column:
    """malformed, vendor, generated or secret as a struct of reason, signal, value and threshold; else null."""
    text, true, false = F.col(content), F.lit(1.0), F.lit(0.0)
    return (
        F.when(is_malformed(text), rejection("malformed", "valid_text", false, 1.0))
        .when(is_vendor(documents), rejection("vendor", "is_vendor", true, 0.0))
        .when(is_generated(text), rejection("generated", "generated_marker", true, 0.0))
        .when(has_secret(text), rejection("secret", "secret_pattern", true, 0.0))
    )


def quality_filter(documents: DataFrame, parser: Parser | None = None, rules: list[Rule] = RULES, content: str = "content", language: str = "language") -> DataFrame:
    """documents with quality_signals and rejection_reason, _signal, _value and _threshold.

    A null reason accepts a document. Signals are measured, and the parser asked, only
    for documents that pass the text checks; the others have null signals. Columns of
    these names in the input are replaced.
    """
    made = ["quality_signals", "rejection_reason", "rejection_signal", "rejection_value", "rejection_threshold"]
    checked = documents.drop(*made).withColumn("_text", text_rejection(documents, content))
    checked = checked.withColumn("_measured", F.when(F.col("_text").isNull(), F.col(content)))
    measured = with_signals(checked, parser, "_measured", language)
    found = F.coalesce(F.col("_text"), F.when(F.col("quality_signals").isNotNull(), first_rejection(F.col("quality_signals"), rules)))
    out = measured.withColumn("_found", found)
    for part in ("reason", "signal", "value", "threshold"):
        out = out.withColumn(f"rejection_{part}", F.col("_found")[part])
    return out.drop("_text", "_measured", "_found")


def accepted(filtered: DataFrame) -> DataFrame:
    return filtered.where("rejection_reason is null").drop("rejection_reason", "rejection_signal", "rejection_value", "rejection_threshold")
