"""The whole course: clean, decontaminate, generate, validate, merge, publish."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import parsers
from siltstone.functions.signals import Parser
from siltstone.operators import decontaminate as D
from siltstone.operators import filters, statistics
from siltstone.operators.dedup import THRESHOLD, exact_deduplicate, near_deduplicate
from siltstone.operators.endpoint import ChatModel, Generator, load_model_specs, reachable_at
from siltstone.operators.generation import MODEL_VERSIONS, Client, branch_parents, generate_branches, generate_mock, generate_real
from siltstone.operators.quotas import METHODS
from siltstone.operators.rules import RULES, Rule
from siltstone.operators.sandbox import IMAGE, ContainerSandbox
from siltstone.operators.validation import validate_generated
from siltstone.session import build_session, cut
from siltstone.sources import files, sinks
from siltstone.sources.jsonl import read_evaluation, read_jsonl


@dataclass
class Options:
    threshold: float = THRESHOLD
    rules: list[Rule] | None = None
    parser: Parser | None = field(default_factory=parsers.parser)
    cohort_per_model: int = 1000
    cohort_language: str = "python"
    post_generation_decontamination: bool = False
    mode: str = "mock"
    client: Client | None = None
    retries: int = 2
    concurrency: int = 2

    def check(self) -> None:
        """Raises where options make no sense together."""
        if self.mode not in ("mock", "real"):
            raise ValueError(f"mode must be mock or real, not {self.mode}")
        if (self.mode == "real") != (self.client is not None):
            raise ValueError("real mode needs a client, mock mode takes none")
        if self.cohort_per_model < 0 or self.retries < 0 or self.concurrency < 1:
            raise ValueError("cohort_per_model and retries must not be negative, concurrency must be positive")


def clean(documents: DataFrame, order: list[str], options: Options | None = None) -> DataFrame:
    """Deduplicated documents with their verdict; order: columns that give the order of input."""
    options = options or Options()
    once = cut(exact_deduplicate(documents, order))
    near = near_deduplicate(once.withColumn("_place", F.struct(*order)), "_place", options.threshold).drop("_place")
    return filters.quality_filter(near, options.parser, options.rules or RULES)


def generated(organic: DataFrame, order: list[str], options: Options) -> DataFrame:
    """Records of all branches with their rejection_reason; a record that could not be made has its error there."""
    if options.mode == "mock":
        return validate_generated(generate_branches(organic, order, options.cohort_per_model, options.cohort_language))
    made = generate_real(branch_parents(organic, order, options.cohort_per_model, options.cohort_language), options.client, retries=options.retries, concurrency=options.concurrency)
    judged = validate_generated(made)
    return judged.withColumn("rejection_reason", F.coalesce("error", "rejection_reason"))


def synthesize_branch(organic: DataFrame, order: list[str], model: str, method: str, output: str, options: Options | None = None) -> DataFrame:
    """One branch by itself: its parents, its records, its audit and its file under output; the accepted records."""
    options = options or Options()
    options.check()
    if model not in MODEL_VERSIONS or method not in METHODS:
        raise ValueError(f"unknown branch: {model}/{method}")
    own = branch_parents(organic, order, options.cohort_per_model, options.cohort_language).where((F.col("model") == model) & (F.col("method") == method))
    if options.mode == "mock":
        judged = cut(validate_generated(generate_mock(own)))
    else:
        made = validate_generated(generate_real(own, options.client, retries=options.retries, concurrency=options.concurrency))
        judged = cut(made.withColumn("rejection_reason", F.coalesce("error", "rejection_reason")))
    sinks.write_audit(judged.where("rejection_reason is not null"), f"{output}/generation-rejections/{model}-{method}")
    accepted = judged.where("rejection_reason is null").drop("rejection_reason", "error")
    accepted.orderBy("document_id").write.mode("errorifexists").json(f"{output}/branches/{model}-{method}", lineSep="\n")
    return accepted


def run(documents: DataFrame, evaluation: DataFrame, order: list[str], output: str, options: Options | None = None) -> dict:
    """Runs everything, writes dataset, audits, branches and manifest under output."""
    options = options or Options()
    options.check()
    spark = documents.sparkSession
    with sinks.RunStatus(spark, output):
        files.make_folder(spark, output)
        judged = cut(clean(documents, order, options))
        sinks.write_audit(judged.where("rejection_reason is not null"), f"{output}/quality-rejections")
        organic = cut(D.drop_evaluation_matches(filters.accepted(judged), evaluation, "document_id"))
        made = cut(generated(organic, order, options))
        sinks.write_audit(made.where("rejection_reason is not null"), f"{output}/generation-rejections")
        synthetic = made.where("rejection_reason is null").drop("rejection_reason", "error")
        leaked = 0
        if options.post_generation_decontamination:
            checked = cut(D.decontaminate(synthetic, evaluation, "document_id"))
            leaked = checked.where("rejection_reason is not null").count()
            sinks.write_audit(checked.where("rejection_reason is not null"), f"{output}/export-rejections")
            synthetic = checked.where("rejection_reason is null").drop("rejection_reason")
        sinks.write_branches(synthetic, f"{output}/branches")
        sinks.write_dataset(organic, synthetic, output)
        counts = evaluation.count()
        more = {"mode": options.mode, "evaluation_documents": counts, "evaluation_configured": bool(counts), "post_generation_deduplication": False, "post_generation_decontamination": options.post_generation_decontamination, "synthetic_contaminated": leaked}
        return sinks.write_manifest(statistics.manifest(organic, synthetic, options.cohort_per_model), f"{output}/manifest.json", **more)


def add_model_arguments(parser: argparse.ArgumentParser) -> None:
    """The options of real mode, the same in all commands."""
    parser.add_argument("--mode", choices=("mock", "real"), default="mock")
    parser.add_argument("--models", default="", help="JSON file with the specifications of the models")
    parser.add_argument("--retries", type=int, default=2)
    parser.add_argument("--concurrency", type=int, default=2)
    parser.add_argument("--image", default=IMAGE, help="container image traces are made in; it must be there")


def client_of(given: argparse.Namespace, environment: dict[str, str] | None = None, send: Callable | None = None) -> Client | None:
    """The generator that real mode asks; None in mock mode. Every model must be behind an endpoint."""
    if given.mode == "mock":
        return None
    environment = dict(os.environ) if environment is None else environment
    models = {}
    for name, spec in load_model_specs(given.models).items():
        kind, place = reachable_at(spec, environment)
        if kind != "endpoint":
            raise RuntimeError(f"{name}: a local folder needs a runtime of its own; name an endpoint")
        models[name] = ChatModel(spec.model_id, place, **({"send": send} if send else {}))
    return Generator(models, ContainerSandbox(image=given.image))


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(description="Curate a corpus of source code.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--evaluation", default="")
    parser.add_argument("--post-generation-decontamination", action="store_true")
    parser.add_argument("--codetrace-documents-per-model", type=int, default=1000)
    add_model_arguments(parser)
    given = parser.parse_args(arguments)
    client = client_of(given)
    spark = spark or build_session()
    options = Options(cohort_per_model=given.codetrace_documents_per_model, post_generation_decontamination=given.post_generation_decontamination, mode=given.mode, client=client, retries=given.retries, concurrency=given.concurrency)
    run(read_jsonl(spark, given.input), read_evaluation(spark, given.evaluation), ["document_id"], given.output, options)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
