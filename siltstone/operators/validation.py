"""Checks of generated records."""

from __future__ import annotations

import ast
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from siltstone.operators.filters import has_secret, is_malformed
from siltstone.session import ensure_importable

#: Methods whose records are prose around code, and the fences of Python blocks (fixed values).
WRAPPED = ["codedev", "codeqa", "codetrace"]
BLOCK = r"(?s)```(?:python|py)[\p{IsWhite_Space}\x1c-\x1f]*\n(.*?)```"


def parses(code: str) -> bool:
    try:
        ast.parse(code)
        return True
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False


@F.pandas_udf(BooleanType())
def all_parse(blocks: pd.Series) -> pd.Series:
    """All texts of a list are Python; null for null and for empty lists."""
    return pd.Series([all(map(parses, b)) if b is not None and len(b) else None for b in blocks], dtype="object")


def validate_generated(records: DataFrame, content: str = "content") -> DataFrame:
    """records with validation and rejection_reason; a null reason accepts a record.

    Only Python is parsed: fenced blocks in wrapped records, the whole text of other
    records whose language is 'Python'. A null text is malformed. Python code goes to the
    parser only where there is some, in Arrow batches.
    """
    ensure_importable(records.sparkSession)
    names = dict(records.dtypes)
    col = lambda c, kind: F.col(c).cast(kind) if c in names else F.lit(None).cast(kind)
    text, method = F.col(content), col("method", "string")
    bad = is_malformed(text)
    blocks = F.regexp_extract_all(text, F.lit(BLOCK), F.lit(1))
    wrapped = F.coalesce(method.isin(WRAPPED), F.lit(False))
    whole = F.coalesce((col("language", "string") == "Python") & ~wrapped, F.lit(False))
    code = F.when(wrapped & (F.size(blocks) > 0), blocks).when(whole & text.isNotNull(), F.array(text))
    kind = (
        F.when(wrapped & (F.size("_code") > 0), "python_ast_embedded")
        .when(method == "codetrace", "runtime_trace")
        .when(wrapped, "embedded_code_unchecked")
        .when(whole, "python_ast")
        .otherwise("not_applicable")
    )
    checked = F.coalesce(col("execution_checked", "boolean"), F.lit(False))
    deterministic = col("trace_deterministic", "boolean")
    proven = checked & F.coalesce(deterministic, F.lit(False))
    no_evidence = (method == "codetrace") & ~F.coalesce(col("mock", "boolean"), F.lit(False)) & ~proven
    reason = F.when(no_evidence, "missing_runtime_trace_evidence").when(bad, "malformed").when(has_secret(text), "secret").when(~F.col("_valid"), "syntax_invalid")
    out = records.drop("validation", "rejection_reason").withColumn("_code", code).withColumn("_valid", all_parse(F.col("_code")))
    made = F.struct(F.col("_valid").alias("syntax_valid"), kind.alias("syntax_check"), F.lit(False).alias("correctness_verified"), checked.alias("execution_checked"), deterministic.alias("trace_deterministic"))
    return out.withColumn("validation", made).withColumn("rejection_reason", reason).drop("_code", "_valid")


_BLOCKS = re.compile(r"```(?:python|py)\s*\n(.*?)```", re.DOTALL)
_SECRET = re.compile(r"(?:api[_-]?key|secret|password|token)\s*[:=]\s*['\"][^'\"]{8,}['\"]|AKIA[0-9A-Z]{16}", re.IGNORECASE)


def worker_reason(record: dict) -> str | None:
    """What validate_generated() would say of one record, for a worker that is to try again at once."""
    text, method = record.get("content"), record.get("method")
    if method == "codetrace" and not record.get("mock") and not (record.get("execution_checked") and record.get("trace_deterministic")):
        return "missing_runtime_trace_evidence"
    if text is None or not text.strip() or "\x00" in text:
        return "malformed"
    if _SECRET.search(text):
        return "secret"
    code = _BLOCKS.findall(text) if method in WRAPPED else [text] if record.get("language") == "Python" else []
    return None if all(map(parses, code)) else "syntax_invalid"
