"""Counts, manifests and paired statistics."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.operators.quotas import COHORT_METHOD

#: The 97.5 % point of the normal distribution, and what a clear result needs (fixed values).
Z = 1.959963984540054
LEAST_DOCUMENTS, LEAST_REPOSITORIES, LEAST_DIFFERENCE, LEVEL = 1000, 200, 0.05, 0.05


def wilson(successes: Column, total: Column) -> Column:
    """Interval of a rate as an array of two numbers; [0, 0] without trials."""
    n, p = total.cast("double"), successes.cast("double") / total.cast("double")
    scale = 1 + Z * Z / n
    centre = (p + Z * Z / (2 * n)) / scale
    half = Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n)) / scale
    return F.when(total > 0, F.array(F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half))).otherwise(F.array(F.lit(0.0), F.lit(0.0)))


def mcnemar_exact(only_first: int, only_second: int) -> float:
    """Two-sided exact binomial test of discordant pairs, in whole numbers until the last division."""
    n = only_first + only_second
    if not n:
        return 1.0
    below, term = 0, 1
    for k in range(min(only_first, only_second) + 1):
        below += term
        term = term * (n - k) // (k + 1)
    return min(1.0, 2 * below / 2**n)


def upper_median(values: str, kind: str = "bigint") -> Column:
    """The middle value, the upper one of two; null without values. One counter per distinct value.

    The discrete median of the descending values is the upper one, and Spark's aggregate keeps
    a count per value, added up before the shuffle. kind: the type of values.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{values}` DESC)").cast(kind)


def by_language(documents: DataFrame) -> DataFrame:
    return documents.groupBy("language").agg(F.count("*").alias("n_documents"))


def by_branch(synthetic: DataFrame) -> DataFrame:
    return synthetic.groupBy("model", "method").agg(F.count("*").alias("n_documents"))


def stored_tokens(documents: DataFrame) -> Column:
    counted = T.token_count(F.col("content")).cast("bigint")
    return F.coalesce(F.col("token_count").cast("bigint"), counted) if "token_count" in documents.columns else counted


def manifest(organic: DataFrame, synthetic: DataFrame, cohort_per_model: int = 1000) -> DataFrame:
    """One row of counts, targets, shortfalls and token sums of a dataset."""
    first = organic.agg(F.count("*").alias("organic_documents"), F.coalesce(F.sum(stored_tokens(organic)), F.lit(0)).alias("organic_token_count"))
    traced = F.count_if(F.col("method") == COHORT_METHOD)
    second = synthetic.agg(F.count("*").alias("synthetic_documents"), traced.alias("codetrace_pilot_accepted_documents"), F.coalesce(F.sum(stored_tokens(synthetic)), F.lit(0)).alias("synthetic_token_count"))
    branches = by_branch(synthetic).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat_ws("/", "model", "method"), "n_documents")))).alias("synthetic_by_model_method"))
    base = F.bround(F.col("organic_documents") * 1.5).cast("bigint")
    trace = F.lit(2 * cohort_per_model).cast("bigint")
    accepted = F.col("synthetic_documents") - F.col("codetrace_pilot_accepted_documents")
    short = lambda target, have: F.greatest(F.lit(0).cast("bigint"), target - have)
    parts = first.unionByName(second, allowMissingColumns=True).unionByName(branches, allowMissingColumns=True)
    whole = parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns])
    return whole.select(
        "organic_documents",
        "synthetic_documents",
        base.alias("base_synthetic_target_documents"),
        accepted.alias("base_synthetic_accepted_documents"),
        short(base, accepted).alias("base_synthetic_shortfall_documents"),
        F.lit(cohort_per_model).cast("bigint").alias("codetrace_pilot_target_per_model"),
        trace.alias("codetrace_pilot_target_documents"),
        "codetrace_pilot_accepted_documents",
        short(trace, F.col("codetrace_pilot_accepted_documents")).alias("codetrace_pilot_shortfall_documents"),
        (base + trace).alias("synthetic_target_documents"),
        short(base + trace, F.col("synthetic_documents")).alias("synthetic_shortfall_documents"),
        (F.col("organic_documents") + F.col("synthetic_documents")).alias("total_documents"),
        "organic_token_count",
        "synthetic_token_count",
        "synthetic_by_model_method",
        F.when(short(base + trace, F.col("synthetic_documents")) > 0, "completed_with_shortfalls").otherwise("completed").alias("status"),
    )


def paired_outcomes(parents: DataFrame, outcomes: DataFrame, first: str, second: str, key: str = "parent_document_id") -> DataFrame:
    """One row: attempts, successes of each model alone, of both and of none.

    parents: the distinct keys attempted. outcomes: key, model, accepted; repeated rows count
    once, a parent with any accepted row of a model succeeded there, one without rows failed.
    """
    per = outcomes.groupBy(key).agg(*[F.coalesce(F.max((F.col("model") == m) & F.col("accepted")), F.lit(False)).alias(n) for m, n in ((first, "_a"), (second, "_b"))])
    joined = parents.select(key).distinct().join(per, key, "left")
    a, b = F.coalesce("_a", F.lit(False)), F.coalesce("_b", F.lit(False))
    return joined.agg(
        F.count("*").alias("attempted"),
        F.count_if(a).alias("first_accepted"),
        F.count_if(b).alias("second_accepted"),
        F.count_if(a & b).alias("both_succeeded"),
        F.count_if(a & ~b).alias("first_only"),
        F.count_if(b & ~a).alias("second_only"),
        F.count_if(~a & ~b).alias("neither"),
    )


def compare(outcomes: DataFrame) -> DataFrame:
    """paired_outcomes() with rates, intervals, the exact test and whether the difference is clear.

    The test needs exact whole numbers of any size, so it runs on the driver, on one row.
    """
    row = outcomes.first()
    p = mcnemar_exact(row["first_only"], row["second_only"])
    rate = lambda c: F.col(c).cast("double") / F.greatest(F.col("attempted"), F.lit(1)).cast("double")
    gap = rate("first_accepted") - rate("second_accepted")
    return outcomes.select(
        "*",
        rate("first_accepted").alias("first_rate"),
        rate("second_accepted").alias("second_rate"),
        wilson(F.col("first_accepted"), F.col("attempted")).alias("first_interval"),
        wilson(F.col("second_accepted"), F.col("attempted")).alias("second_interval"),
        gap.alias("rate_difference"),
        F.lit(p).alias("p_value"),
        ((F.abs(gap) >= LEAST_DIFFERENCE) & F.lit(p < LEVEL)).alias("clear_difference"),
    )


def unique_repositories(documents: DataFrame) -> DataFrame:
    """One row: distinct repositories (repo_id, else repo_path); those without either count as one."""
    key = F.coalesce(F.when(F.col("repo_id").cast("string") != "", F.col("repo_id").cast("string")), F.col("repo_path"))
    return documents.agg((F.countDistinct(key) + F.when(F.count_if(key.isNull()) > 0, 1).otherwise(0)).alias("n_repositories"), F.count("*").alias("n_documents"))


def sampling_is_enough(documents: int, repositories: int) -> bool:
    return documents >= LEAST_DOCUMENTS and repositories >= LEAST_REPOSITORIES
