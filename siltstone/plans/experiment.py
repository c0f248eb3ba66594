"""The paired experiment: both models on one cohort, compared by what their records pass."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import filters, statistics, trace
from siltstone.operators.generation import MODEL_VERSIONS, Client, generate_mock, generate_real
from siltstone.operators.quotas import COHORT_METHOD, cohort
from siltstone.operators.validation import validate_generated
from siltstone.plans.pipeline import Options, add_model_arguments, clean, client_of
from siltstone.session import build_session, cut
from siltstone.sources import files
from siltstone.sources.jsonl import read_jsonl

FIRST, SECOND = MODEL_VERSIONS


def attempts(documents: DataFrame, order: list[str], limit: int, client: Client | None = None, retries: int = 2, concurrency: int = 2) -> tuple[DataFrame, DataFrame]:
    """Parents, and one record per parent and model with its rejection_reason; without a client in mock mode."""
    parents = cut(cohort(documents, order, limit))
    asked = parents.drop("model", "method").withColumn("model", F.explode(F.array(F.lit(FIRST), F.lit(SECOND)))).withColumn("method", F.lit(COHORT_METHOD))
    if client is None:
        return parents, cut(validate_generated(generate_mock(asked)))
    judged = validate_generated(generate_real(asked, client, retries=retries, concurrency=concurrency))
    return parents, cut(judged.withColumn("rejection_reason", F.coalesce("error", "rejection_reason")))


def summarise(parents: DataFrame, records: DataFrame, requested: int, rejected: int, mode: str) -> dict:
    """The comparison as a dictionary; traces are measured in real mode only."""
    outcomes = records.select("parent_document_id", "model", F.col("rejection_reason").isNull().alias("accepted"))
    keys = parents.select(F.col("document_id").cast("string").alias("parent_document_id"))
    row = statistics.compare(statistics.paired_outcomes(keys, outcomes, FIRST, SECOND)).first()
    repositories = statistics.unique_repositories(parents).first()["n_repositories"]
    medians: dict[str, int] = {}
    if mode == "real":
        accepted = trace.with_metrics(records.where("rejection_reason is null").select("model", "content"))
        medians = {r["model"]: r["m"] for r in accepted.groupBy("model").agg(statistics.upper_median("trace_events").alias("m")).collect()}
    side = lambda n, model: {"accepted": row[f"{n}_accepted"], "acceptance_rate": row[f"{n}_rate"], "acceptance_rate_95pct_wilson": list(row[f"{n}_interval"]), "median_trace_events": medians.get(model)}
    return {
        "mode": mode,
        "mock_results_are_not_evidence": mode == "mock",
        "requested_shared_parents": requested,
        "attempted_shared_parents": row["attempted"],
        "unique_repositories": repositories,
        "quality_rejected_before_sampling": rejected,
        "models": {FIRST: side("first", FIRST), SECOND: side("second", SECOND)},
        "paired_outcomes": {
            "both_succeeded": row["both_succeeded"],
            f"{FIRST}_only": row["first_only"],
            f"{SECOND}_only": row["second_only"],
            "neither": row["neither"],
            "acceptance_rate_difference": row["rate_difference"],
            "mcnemar_exact_p_value": row["p_value"],
        },
        "sampling_requirement_met": statistics.sampling_is_enough(row["attempted"], repositories),
        "clear_model_difference": row["clear_difference"],
    }


def run(documents: DataFrame, order: list[str], output: str, limit: int = 1000, options: Options | None = None) -> dict:
    """Cleans, samples, generates and compares; writes records per model, failures and summary.json, over earlier ones."""
    options = options or Options()
    options.check()
    spark = documents.sparkSession
    judged = cut(clean(documents, order, options))
    parents, records = attempts(filters.accepted(judged), order, limit, options.client, options.retries, options.concurrency)
    files.make_folder(spark, output)
    for model in MODEL_VERSIONS:
        records.where((F.col("model") == model) & F.col("rejection_reason").isNull()).drop("rejection_reason").write.mode("overwrite").json(f"{output}/{model}")
    failed = records.where("rejection_reason is not null").select("parent_document_id", "model", "method", F.col("rejection_reason").alias("error"))
    failed.write.mode("overwrite").json(f"{output}/failures")
    summary = summarise(parents, records, limit, judged.where("rejection_reason is not null").count(), options.mode)
    files.write_text(spark, f"{output}/summary.json", json.dumps(summary, indent=2) + "\n", overwrite=True)
    return summary


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(description="Compare both models on the same parents.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--documents", type=int, default=1000)
    add_model_arguments(parser)
    given = parser.parse_args(arguments)
    options = Options(mode=given.mode, client=client_of(given), retries=given.retries, concurrency=given.concurrency)
    spark = spark or build_session()
    run(read_jsonl(spark, given.input), ["document_id"], given.output, given.documents, options)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
