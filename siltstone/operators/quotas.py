"""How many and which documents each branch of generation takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.ranking import ranked, row_key
from siltstone.session import stored

#: Branches in their order, and the method that takes a cohort instead of a quota (fixed values).
MODELS = ["qwen_coder", "codegemma"]
BASE_METHODS = ["swallowcode", "codedev", "codeqa"]
COHORT_METHOD = "codetrace"
METHODS = [*BASE_METHODS, COHORT_METHOD]
BASE_BRANCHES = [(m, t) for m in MODELS for t in BASE_METHODS]
BRANCHES = [(m, t) for m in MODELS for t in METHODS]
SHARE = 1.5


def branch_quota(n: Column, index: Column, branches: int = len(BASE_BRANCHES)) -> Column:
    """Documents of a base branch: 1.5 n in all (half to even), spread with the rest on the first branches."""
    total = F.bround(F.lit(SHARE) * n).cast("bigint")
    return F.floor(total / branches) + F.when(index < total % branches, 1).otherwise(0)


def quotas(documents: DataFrame) -> DataFrame:
    """branch (from 0), model, method, quota of the base branches."""
    n = documents.agg(F.count("*").alias("n"))
    return n.select("n", F.explode(_branches()).alias("x")).select("x.branch", "x.model", "x.method", branch_quota(F.col("n"), F.col("x.branch")).alias("quota"))


def _branches() -> Column:
    """Array of the base branches."""
    return F.array(*[F.struct(F.lit(i).alias("branch"), F.lit(m).alias("model"), F.lit(t).alias("method")) for i, (m, t) in enumerate(BASE_BRANCHES)])


def language_allocations(documents: DataFrame, language: str = "language") -> DataFrame:
    """model, method, language, n, total, allocated: a branch's quota in proportion to the languages.

    Whole parts first, what is left one by one to the largest remainders, ties by name.
    A null language is a group of its own and comes last.
    """
    counts = documents.groupBy(F.col(language).alias("language")).agg(F.count("*").alias("n"))
    whole = counts.agg(F.collect_list(F.struct("language", "n")).alias("languages"), F.sum("n").alias("total"))
    table = whole.select("languages", "total", F.explode(_branches()).alias("b")).select("b.*", "total", F.explode("languages").alias("l")).select("branch", "model", "method", "total", "l.*")
    table = table.withColumn("quota", branch_quota(F.col("total"), F.col("branch")))
    product = F.col("quota") * F.col("n")
    shares = table.withColumn("whole", F.floor(product / F.col("total"))).withColumn("rest", product % F.col("total"))
    rank = F.row_number().over(Window.partitionBy("branch").orderBy(F.desc("rest"), F.asc_nulls_last("language")))
    missing = F.col("quota") - F.sum("whole").over(Window.partitionBy("branch"))
    extra = F.when(F.col("_rank") <= F.col("_missing"), 1).otherwise(0)
    return shares.withColumn("_rank", rank).withColumn("_missing", missing).select("branch", "model", "method", "language", "n", "total", (F.col("whole") + extra).alias("allocated"))


def _place(turn: Column, language: Column, shares: Column) -> Column:
    """Place of a document in its branch, where languages take turns and drop out at their allocation.

    shares: array of structs of language and allocated. Before turn t of a language come all
    earlier turns of every language, and turn t of those with a lesser name; null is the last.
    """
    first = lambda x: F.coalesce(x["language"] < language, x["language"].isNotNull() & language.isNull())
    earlier = F.aggregate(shares, F.lit(0).cast("bigint"), lambda n, x: n + F.least(x["allocated"], turn - 1))
    return (earlier + F.size(F.filter(shares, lambda x: (x["allocated"] >= turn) & first(x))) + 1).cast("int")


def base_parents(documents: DataFrame, order: list[str], language: str = "language") -> DataFrame:
    """Parents of all base branches: documents with branch, model, method and place (from 1) in the branch.

    Languages take turns, each gives its documents in the order of input up to its
    allocation. As branches take the first documents of each language, a document is
    ranked once, whatever the number of branches, and only keys are ranked; places follow
    from the allocations by counting. Texts are joined last, those of chosen documents only.
    Columns of these names are replaced. documents is read several times: give a table.
    """
    own = documents.drop("branch", "model", "method", "place")
    keys = row_key(own)
    shares = F.collect_list(F.struct(F.col("language"), F.col("allocated").cast("bigint").alias("allocated")))
    allocations = stored(language_allocations(own, language).where("allocated > 0").select("branch", "model", "method", "language", "allocated"))
    mine = allocations.withColumn("_l", F.struct("language")).drop("language")
    per_branch = allocations.groupBy("branch").agg(shares.alias("_shares"))
    turns = ranked(own.select(*keys, F.struct(F.col(language).alias("language")).alias("_l"), F.struct(*order).alias("_order")), [F.col("_l")], [F.col("_order")], "_turn").drop("_order")
    chosen = turns.join(mine, "_l").where("_turn <= allocated").join(per_branch, "branch")
    placed = chosen.select("_k1", "_k2", "branch", "model", "method", _place(F.col("_turn"), F.col("_l.language"), F.col("_shares")).alias("place"))
    return _with_rows(own, placed)


def _with_rows(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """keys with the columns of the rows they are the row_key of; equal rows count once, as each has keys of its own."""
    once = rows.select("*", *row_key(rows)).join(keys.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return once.join(keys, ["_k1", "_k2"]).drop("_k1", "_k2")


def repository_key(documents: DataFrame) -> Column:
    """repo_id, else repo_path, else document_id: the first that is neither null, empty nor zero."""
    parts = []
    for name in ("repo_id", "repo_path"):
        if name in documents.columns:
            value = F.col(name).cast("string")
            zero = (value != "0") if dict(documents.dtypes)[name] in ("int", "bigint", "smallint", "tinyint") else F.lit(True)
            parts.append(F.when((value != "") & zero, value))
    return F.coalesce(*parts, F.col("document_id").cast("string"))


def cohort(documents: DataFrame, order: list[str], limit: int = 1000, language: str = "python") -> DataFrame:
    """Up to limit documents of a language, the repositories taking turns; with place from 1.

    Inside a repository documents come by document_id, then by the order of input. Keys
    alone are ranked, a repository of any size in many tasks; the first limit ones are a
    distributed top-k, and only they are numbered and get their texts.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    own = documents.drop("place").where(F.lower("language") == language)
    slim = own.select(*row_key(own), repository_key(own).alias("_repo"), F.struct(F.col("document_id").cast("string").alias("d"), *order).alias("_order"))
    turns = ranked(slim, [F.col("_repo")], [F.col("_order")], "_turn").drop("_order")
    first = turns.orderBy("_turn", "_repo").limit(limit)
    placed = first.select("_k1", "_k2", F.row_number().over(Window.orderBy("_turn", "_repo")).alias("place"))
    return _with_rows(own, placed)
