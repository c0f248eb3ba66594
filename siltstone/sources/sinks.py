"""Writing datasets, audits, branches and manifests; existing results are never overwritten."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.sources import files

#: The only fields an audit may hold: never a text (fixed values).
AUDIT_FIELDS = ["document_id", "parent_document_id", "model", "method", "quality_signals", "rejection_reason", "rejection_signal", "rejection_value", "rejection_threshold", "error"]


def merged(organic: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Organic, then synthetic documents, with token_count counted anew."""
    both = organic.unionByName(synthetic, allowMissingColumns=True)
    return both.withColumn("token_count", T.token_count(F.col("content")))


def write_dataset(organic: DataFrame, synthetic: DataFrame, folder: str) -> None:
    """JSON lines in folder/train; null fields are left out of their line."""
    merged(organic, synthetic).write.mode("errorifexists").json(f"{folder}/train", lineSep="\n")


def write_audit(rows: DataFrame, path: str) -> None:
    """The audit fields that rows has, as JSON lines."""
    rows.select(*[c for c in AUDIT_FIELDS if c in rows.columns]).write.mode("errorifexists").json(path, lineSep="\n")


def write_branches(records: DataFrame, path: str) -> None:
    """One folder per model and method."""
    records.write.mode("errorifexists").partitionBy("model", "method").json(path)


def write_sample(documents: DataFrame, path: str) -> None:
    """Documents sorted by language and id."""
    documents.orderBy("language", "document_id").write.mode("errorifexists").json(path, lineSep="\n")


def write_manifest(manifest: DataFrame, path: str, **more: object) -> dict:
    """The single row of a manifest, further fields and the time, as a JSON file that must not exist."""
    row = json.loads(manifest.toJSON().first())
    body = {"created_at_utc": datetime.now(UTC).isoformat(), "token_count_method": "whitespace_estimate_not_model_tokens", **row, **more}
    files.write_text(manifest.sparkSession, path, json.dumps(body, indent=2, ensure_ascii=False) + "\n")
    return body


class RunStatus:
    """A JSON file beside the output that tells whether a run goes on, has ended, failed or was broken off."""

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.path = spark, f"{output.rstrip('/')}.status.json"
        if files.exists(spark, output):
            raise FileExistsError(output)

    def _write(self, state: str, **more: object) -> None:
        files.write_text(self.spark, self.path, json.dumps({"state": state, "time_utc": datetime.now(UTC).isoformat(), **more}) + "\n", overwrite=True)

    def __enter__(self) -> RunStatus:
        self._write("running")
        return self

    def __exit__(self, kind, error, _) -> None:
        if kind is None:
            self._write("finished", exit_code=0)
        else:
            self._write("interrupted" if issubclass(kind, KeyboardInterrupt) else "failed", exit_code=1, error=str(error))
