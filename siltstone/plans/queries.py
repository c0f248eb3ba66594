"""The core queries, each over its whole tables.

Code documents come in the order of ingested_at, document_id and source_shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import parsers
from siltstone.functions import text as T
from siltstone.functions.signals import with_signals
from siltstone.operators import decontaminate as D
from siltstone.operators import dedup, filters, generation, quotas, statistics, trace
from siltstone.operators.rules import PROSE_RULES
from siltstone.operators.validation import validate_generated
from siltstone.session import spread, stored
from siltstone.sources import repositories, sinks
from siltstone.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORDER = ["ingested_at", "document_id", "source_shard"]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _code(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "code_documents"))


def _evaluation(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "evaluation_documents")


def _unique(spark: SparkSession, folder: str) -> DataFrame:
    """Code documents without exact duplicates; rows without a text all stay, until screening rejects them."""
    return dedup.exact_deduplicate(_code(spark, folder), ORDER)


def _texts(documents: DataFrame) -> DataFrame:
    """Key and text of documents, written once for the stages that read them again."""
    return stored(documents.select("document_id", "content"))


def _organic(spark: SparkSession, folder: str) -> DataFrame:
    """Unique documents that are no malformed ones and hold no evaluation text, written once for all that reads them."""
    whole = _unique(spark, folder).where(~filters.is_malformed(F.col("content")))
    return stored(D.drop_evaluation_matches(whole, _evaluation(spark, folder), "document_id"))


# Deduplication and decontamination


@query
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_deduplicate(_code(spark, folder), ORDER).select("document_id", "source_shard", "content_hash")


@query
def normalize_hash(spark: SparkSession, folder: str) -> DataFrame:
    plain = T.normalize(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", F.length(plain).alias("n_characters"), T.content_hash(plain).alias("hash"))


@query
def shingle_stats(spark: SparkSession, folder: str) -> DataFrame:
    items = T.tokens(F.col("content"))
    return _evaluation(spark, folder).select("document_id", F.size(items).alias("n_tokens"), F.size(T.shingles(items)).alias("n_shingles"))


@query
def near_dup_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of different texts that are 0.8 similar or more."""
    pairs = dedup.similar_pairs(dedup.keyed(_texts(_unique(spark, folder)), "document_id"), 0.8)
    return pairs.select("a", "b", F.round("similarity", 9).alias("similarity"))


@query
def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_deduplicate(_texts(_unique(spark, folder)), "document_id", 0.8).select("document_id")


@query
def near_dedup_generated(spark: SparkSession, folder: str) -> DataFrame:
    """Generated records without near duplicates: many share a parent, so similar ones form chains and clusters."""
    made = table(spark, folder, "synthetic_documents").select("document_id", "content").dropDuplicates(["document_id"])
    return dedup.near_deduplicate(stored(made), "document_id", 0.8).select("document_id")


@query
def cross_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Generated records that repeat a code document or an earlier record."""
    made = table(spark, folder, "synthetic_documents").select("document_id", "content").dropDuplicates(["document_id"])
    judged = dedup.cross_deduplicate(_texts(_unique(spark, folder)), _texts(made), "document_id")
    return judged.select("document_id", "rejection_reason")


@query
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return D.decontaminate(_unique(spark, folder), _evaluation(spark, folder), "document_id").select("document_id", "rejection_reason")


# Signals and screening


@query
def quality_text_signals(spark: SparkSession, folder: str) -> DataFrame:
    s = with_signals(_unique(spark, folder))
    counts = [f"quality_signals.{c}" for c in ("num_characters", "num_bytes", "num_words", "num_lines", "max_line_length")]
    return s.select("document_id", *counts, F.coalesce("quality_signals.parse_supported", F.lit(False)).alias("parse_supported"))


@query
def quality_ratio_signals(spark: SparkSession, folder: str) -> DataFrame:
    names = ["mean_word_length", "mean_line_length", "replacement_character_fraction", "duplicate_line_fraction", "alphabetic_fraction", "numeric_fraction", "whitespace_fraction", "encoded_data_fraction"]
    return with_signals(_unique(spark, folder)).select("document_id", *[F.round(f"quality_signals.{c}", 9).alias(c) for c in names])


@query
def ngram_signals(spark: SparkSession, folder: str) -> DataFrame:
    s = with_signals(_unique(spark, folder))
    return s.select("document_id", *[F.round(f"quality_signals.top_{k}gram_fraction", 9).alias(f"top_{k}gram_fraction") for k in (2, 3, 4)])


@query
def lexical_signals(spark: SparkSession, folder: str) -> DataFrame:
    s = with_signals(_unique(spark, folder))
    return s.select("document_id", *[F.round(f"quality_signals.{c}", 9).alias(c) for c in ("comment_fraction", "long_string_fraction")])


@query
def text_screens(spark: SparkSession, folder: str) -> DataFrame:
    """The four text checks of every delivery, each for itself."""
    code = _code(spark, folder)
    text = F.col("content")
    return code.select("document_id", "source_shard", filters.is_malformed(text).alias("malformed"), filters.is_vendor(code).alias("vendor"), filters.is_generated(text).alias("generated"), filters.has_secret(text).alias("secret"))


@query
def quality_rejections(spark: SparkSession, folder: str) -> DataFrame:
    judged = filters.quality_filter(_unique(spark, folder))
    return judged.select("document_id", "rejection_reason", "rejection_signal", F.round("rejection_value", 9).alias("rejection_value"), "rejection_threshold")


@query
def rejection_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the text table by the rule of the prose profile that rejects them."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("content"), F.col("lang").alias("language"))
    judged = filters.quality_filter(documents, rules=PROSE_RULES)
    return judged.groupBy(F.coalesce("rejection_reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n_documents"))


@query
def curation_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplicated, decontaminated documents by the rule that rejects them."""
    kept = dedup.near_deduplicate(_organic(spark, folder), "document_id", 0.8)
    judged = filters.quality_filter(kept)
    return judged.groupBy(F.coalesce("rejection_reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n_documents"))


# Quotas, generation, validation


@query
def branch_quotas(spark: SparkSession, folder: str) -> DataFrame:
    return quotas.quotas(_organic(spark, folder))


@query
def language_allocations(spark: SparkSession, folder: str) -> DataFrame:
    return quotas.language_allocations(_organic(spark, folder)).select("model", "method", "language", "n", "allocated")


@query
def branch_selection(spark: SparkSession, folder: str) -> DataFrame:
    return quotas.base_parents(_organic(spark, folder), ORDER).select("model", "method", "place", "document_id")


@query
def trace_cohort(spark: SparkSession, folder: str) -> DataFrame:
    return quotas.cohort(_organic(spark, folder), ORDER, 1000).select("place", "document_id")


def _mock(organic: DataFrame) -> DataFrame:
    return generation.generate_branches(organic, ORDER, 1000)


@query
def mock_branches(spark: SparkSession, folder: str) -> DataFrame:
    made = _mock(_organic(spark, folder))
    return made.select("document_id", "parent_document_id", "model", "method", "model_version", "token_count", "mock", "synthetic", F.sha2("content", 256).alias("hash"))


@query
def prompts(spark: SparkSession, folder: str) -> DataFrame:
    asked = generation.prompt(F.col("method"), F.col("language"), F.col("content"))
    return generation.branch_parents(_organic(spark, folder), ORDER).select("model", "method", "document_id", F.sha2(asked, 256).alias("hash"))


@query
def validated_records(spark: SparkSession, folder: str) -> DataFrame:
    """The delivered generated records, with their checks."""
    judged = validate_generated(table(spark, folder, "synthetic_documents"))
    return judged.select("document_id", "generated_at", "validation.syntax_valid", "validation.syntax_check", "rejection_reason").distinct()


@query
def validation_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Mock records by branch and verdict."""
    judged = validate_generated(_mock(_organic(spark, folder)))
    return judged.groupBy("model", "method", "rejection_reason").agg(F.count("*").alias("n_records"))


# Merge and statistics


@query
def merged_corpus(spark: SparkSession, folder: str) -> DataFrame:
    organic = _organic(spark, folder)
    both = sinks.merged(organic, _mock(organic))
    return both.groupBy(F.coalesce("synthetic", F.lit(False)).alias("synthetic"), F.lower("language").alias("language")).agg(F.count("*").alias("n_documents"), F.sum("token_count").alias("n_tokens"))


@query
def manifest_counts(spark: SparkSession, folder: str) -> DataFrame:
    organic = _organic(spark, folder)
    return statistics.manifest(organic, _mock(organic)).drop("synthetic_by_model_method")


@query
def synthetic_by_branch(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.by_branch(table(spark, folder, "synthetic_documents"))


@query
def documents_by_language(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.by_language(_code(spark, folder))


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = table(spark, folder, "paired_outcomes")
    return statistics.paired_outcomes(outcomes, outcomes, "qwen_coder", "codegemma")


@query
def paired_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return _outcomes(spark, folder)


@query
def paired_comparison(spark: SparkSession, folder: str) -> DataFrame:
    compared = statistics.compare(_outcomes(spark, folder))
    return compared.select(
        *[F.round(c, 9).alias(c) for c in ("first_rate", "second_rate", "rate_difference", "p_value")],
        *[F.round(F.element_at(f"{w}_interval", i), 9).alias(f"{w}_{n}") for w in ("first", "second") for i, n in ((1, "low"), (2, "high"))],
        "clear_difference",
    )


@query
def unique_repositories(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.unique_repositories(_code(spark, folder))


@query
def trace_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Traces of the delivered codetrace records."""
    records = table(spark, folder, "synthetic_documents").where("method = 'codetrace' and content is not null").select("document_id", "content").distinct()
    return trace.with_metrics(records).drop("content", "event_types").withColumn("largest_event_type_fraction", F.round("largest_event_type_fraction", 9))


@query
def median_trace_events(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "synthetic_documents").where("method = 'codetrace'").select("document_id", "model", "content").distinct()
    return trace.with_metrics(records).groupBy("model").agg(statistics.upper_median("trace_events").alias("median_trace_events"))


# Ingest


@query
def ingest_repositories(spark: SparkSession, folder: str) -> DataFrame:
    files = repositories.flatten(table(spark, folder, "repositories"), dataset="crawl")
    return repositories.unique_contents(files).groupBy("content_id").agg(F.count("*").alias("n"))


@query
def capped_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Files per repository row when each row may give two."""
    files = repositories.flatten(table(spark, folder, "repositories"), dataset="crawl")
    return repositories.ingest(files, 2).groupBy("order_repo").agg(F.count("*").alias("n_files"))


@query
def ingest_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Files of three wanted kinds, by language, with the fields that have to be there."""
    files = repositories.flatten(table(spark, folder, "repositories"), ["Markdown", "JSON", "YAML", "Text"], "crawl")
    named = F.count_if(F.col("source_dataset") == "crawl")
    return files.groupBy("language").agg(F.count("*").alias("n_files"), F.countDistinct("document_id").alias("n_ids"), F.count_if(F.col("is_vendor")).alias("n_vendor"), F.sum(F.size("detected_licenses")).alias("n_licenses"), named.alias("n_named"))


@query
def decontaminate_generated(spark: SparkSession, folder: str) -> DataFrame:
    """Generated records, with those that hold an evaluation text marked."""
    made = table(spark, folder, "synthetic_documents").select("document_id", "content").dropDuplicates(["document_id"])
    return D.decontaminate(made, _evaluation(spark, folder), "document_id").select("document_id", "rejection_reason")


@query
def record_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Fenced blocks and wrappings of the generated records, and whether a script in them may run."""
    made = table(spark, folder, "synthetic_documents").where("content is not null").select("document_id", "content").dropDuplicates(["document_id"])
    text = F.col("content")
    script = trace.execution_script(text)
    return made.select("document_id", F.sha2(T.fenced_block(text, "python"), 256).alias("python"), F.sha2(T.unwrap_fence(text), 256).alias("unwrapped"), F.sha2(script["script"], 256).alias("script"), script["error"].alias("error"))


@query
def record_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Mock outputs and trace records made of the generated records."""
    made = table(spark, folder, "synthetic_documents").where("content is not null and model is not null and method is not null").select("document_id", "model", "method", "content").dropDuplicates(["document_id"])
    text = F.col("content")
    return made.select("document_id", F.sha2(generation.mock_output(F.col("model"), F.col("method"), text), 256).alias("mock"), F.sha2(trace.format_trace(text, F.col("model"), F.col("method")), 256).alias("record"))


@query
def sampling_requirement(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a sample of the code documents has enough documents and repositories."""
    code = _code(spark, folder)
    counted = statistics.unique_repositories(code)
    enough = (F.col("n_documents") >= statistics.LEAST_DOCUMENTS) & (F.col("n_repositories") >= statistics.LEAST_REPOSITORIES)
    return counted.select("n_documents", "n_repositories", enough.alias("met"))


@query
def parse_screens(spark: SparkSession, folder: str) -> DataFrame:
    """Code documents of Python, and whether they parse; other languages are left to a plug-in."""
    judged = with_signals(_unique(spark, folder).where("lower(language) = 'python' and content is not null"), parsers.parser())
    return judged.select("document_id", F.col("quality_signals.parse_error").alias("parse_error"))
