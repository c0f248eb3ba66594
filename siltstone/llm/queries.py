"""The queries of the training-data problems, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import leaks, licences, mixing, origin, packing, pairs, personal, secrets, syntax, tokens
from siltstone.session import cut, stored
from siltstone.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# 3. Token budget per source and language


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of every row of both tables under one schema."""
    code = table(spark, folder, "code_documents").withColumn("method", F.lit(None).cast("string"))
    made = table(spark, folder, "synthetic_documents")
    keep = ["document_id", "language", "source_dataset", "method", "token_count"]
    return tokens.token_sizes(code, "content", keep).unionByName(tokens.token_sizes(made, "content", keep))


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    sizes = _sizes(spark, folder)
    return sizes.where(tokens.count_is_wrong(F.col("token_count"), F.col("n_words"))).select("document_id").distinct()


@query
def p3_budget(spark: SparkSession, folder: str) -> DataFrame:
    sizes = _sizes(spark, folder).withColumn("language", F.lower("language"))
    return tokens.budget(sizes.dropDuplicates(["document_id"]), ["source_dataset", "language", "method"])


# 5. Evaluation texts leaking into training text


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.find_leaks(table(spark, folder, "code_documents"), table(spark, folder, "evaluation_documents"))


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder).select("item_id", "document_id").distinct()


@query
def p5_items(spark: SparkSession, folder: str) -> DataFrame:
    """Per leaked item: documents that hold it, and the largest part of it in one document."""
    found = _leaks(spark, folder).dropDuplicates(["item_id", "document_id"])
    return found.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.max("run_words").alias("longest_run"), F.max("item_share").alias("largest_share"))


# 1. Source files that do not parse


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    checked = syntax.check_files(table(spark, folder, "code_documents"), ["document_id"])
    return checked.where(syntax.is_invalid(F.col("verdict"))).select("document_id").distinct()


def _checked_once(spark: SparkSession, folder: str) -> DataFrame:
    checked = syntax.check_files(table(spark, folder, "code_documents"), ["document_id", "repo_id", "language"])
    return checked.withColumn("language", F.lower("language")).dropDuplicates(["document_id"])


@query
def p1_rates_by_repo(spark: SparkSession, folder: str) -> DataFrame:
    return syntax.rates(_checked_once(spark, folder), "repo_id")


@query
def p1_rates_by_language(spark: SparkSession, folder: str) -> DataFrame:
    return syntax.rates(_checked_once(spark, folder), "language")


# 2. Generated, minified or vendored source files


def _origins(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    files = table(spark, folder, "code_documents")
    measured = stored(origin.measure(files, ["document_id", "repo_id", "file_path", "is_vendor", *more], rules=False))
    return origin.classify(measured, repo="repo_id")


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _origins(spark, folder).where(~F.col("hand_written")).select("document_id").distinct()


@query
def p2_by_repo(spark: SparkSession, folder: str) -> DataFrame:
    """Files per repository by where they come from; a file counts once, however often delivered."""
    flags = ["generated", "minified", "literal_data", "third_party", "hand_written"]
    once = _origins(spark, folder).select("document_id", "repo_id", *flags).distinct()
    return once.groupBy("repo_id").agg(F.count("*").alias("n_files"), *[F.count_if(c).alias(f"n_{c}") for c in flags])


@query
def p2_shared_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Grammar rules, and runs of 48 tokens, met in several repositories: copied texts and parts of texts."""
    files = table(spark, folder, "code_documents").select("document_id", "repo_id", "content")
    measured = origin.measure(files, ["document_id", "repo_id"], marks=True).select("document_id", "repo_id", "file_rule", "long_rules", "marks")
    measured = cut(measured.dropDuplicates(["document_id"]))
    return origin.shared_rules(measured, runs=origin.shared_runs(files, measured))


# 4. License of each code file and repository


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "code_documents")
    repos = licences.repo_evidence(table(spark, folder, "repositories"))
    evidence = licences.file_evidence(files, ["document_id", "repo_id", "license_type"]).distinct()
    of_files = licences.file_verdicts(evidence, repos).select(F.lit("file").alias("level"), F.col("document_id").alias("entity_id"), "verdict")
    of_repos = licences.repo_verdicts(files, repos).select(F.lit("repo").alias("level"), F.col("repo_id").alias("entity_id"), "verdict")
    return of_files.distinct().unionByName(of_repos)


@query
def p4_by_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return p4_found(spark, folder).groupBy("level", "verdict").agg(F.count("*").alias("n"))


# 6. Broken prompt and response pairs


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "synthetic_documents").where("method in ('codeqa', 'codedev')")
    surveyed = cut(pairs.survey(records, ["document_id", "method", "model"]))
    return pairs.defects(pairs.inspect(surveyed), cut(pairs.end_counts(surveyed)))


@query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder).where("defect is not null").select("document_id", "defect").distinct()


@query
def p6_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Records, and the share of each defect, per method and model."""
    kinds = ["empty", "truncated", "refusal", "copied", "language"]
    shares = [(F.count_if(F.col("defect") == k) / F.count("*")).alias(f"{k}_share") for k in kinds]
    return _pairs(spark, folder).groupBy("method", "model").agg(F.count("*").alias("n_records"), *shares)


# 7. Credentials embedded in source code


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "code_documents")
    return cut(secrets.find_candidates(files, ["document_id", "file_path"]))


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    found = _candidates(spark, folder)
    scored = secrets.score(found, secrets.train(found))
    return scored.where(F.col("score") >= secrets.THRESHOLD).select("document_id", "line_no").distinct()


@query
def p7_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """Files with a credential, their text with every credential taken out."""
    model = secrets.train(_candidates(spark, folder))
    done = secrets.redact(table(spark, folder, "code_documents"), ["document_id", "repo_id"], model)
    return done.where("n_redacted > 0").dropDuplicates(["document_id"])


# 10. Personal information inside free text


@query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = personal.find(documents, ["doc_id"], personal.train(documents))
    return found.select("doc_id", "kind", "start_pos").distinct()


@query
def p10_masked(spark: SparkSession, folder: str) -> DataFrame:
    """Every text with typed placeholders for its personal data."""
    documents = table(spark, folder, "documents")
    return personal.mask(documents, ["doc_id"], personal.train(documents))


# 8. Filling fixed-capacity containers with items, 9. Mixing sources to target weights


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, source, n_tokens of every document, counted once."""
    sizes = tokens.token_sizes(table(spark, folder, "documents"), "text", ["doc_id", "source"])
    return cut(sizes.select("doc_id", mixing.clean_source(F.col("source")).alias("source"), "n_tokens"))


@query
def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_sized(spark, folder), table(spark, folder, "pack_capacities"), cut)


@query
def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill_report(p8_packed(spark, folder))


@query
def p8_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Share of each source in each window of containers, beside its target."""
    return packing.window_shares(p8_packed(spark, folder))


@query
def p8_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Per pack: texts placed, and breaches of capacity, wholeness and once-only."""
    return packing.limits_kept(table(spark, folder, "documents"), p8_packed(spark, folder))


@query
def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    sized = _sized(spark, folder)
    return mixing.mix(sized, mixing.plan(sized, table(spark, folder, "mix_targets")))


@query
def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    sized = _sized(spark, folder)
    return mixing.shares(sized, mixing.plan(sized, table(spark, folder, "mix_targets")))


@query
def p9_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Per mix and source: documents there are, and breaches of the allowed repeats and of the targets."""
    sized = _sized(spark, folder)
    return mixing.limits_kept(sized, mixing.plan(sized, table(spark, folder, "mix_targets")))
