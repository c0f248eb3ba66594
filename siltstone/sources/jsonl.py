"""JSON lines: one document per line, lines end at LF only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: The columns every document source has (fixed values).
DOCUMENT = "document_id string, content_id string, content string, language string, file_path string, repo_path string, repo_id string, commit_id string, license_type string, detected_licenses array<string>, is_vendor boolean, source_dataset string, source_shard string"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str | StructType = DOCUMENT) -> DataFrame:
    """Documents of JSON-lines files. Blank lines are skipped, a line that is no JSON fails the read.

    Unlike str.splitlines, characters such as U+2028 inside a string do not end a line.
    """
    return spark.read.schema(schema).json(path, mode="FAILFAST", lineSep="\n")


def read_evaluation(spark: SparkSession, path: str = "", schema: str | StructType = DOCUMENT) -> DataFrame:
    """Evaluation documents; an empty path is an empty set."""
    return read_jsonl(spark, path, schema) if path else spark.createDataFrame([], schema)
