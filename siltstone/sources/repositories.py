"""Repository snapshots in nested form, as documents."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import cut


def select_shards(names: list[str], start: int = 0, most: int | None = None) -> list[str]:
    """The Parquet files among names, sorted, from start on; an error where none is left or the range makes no sense."""
    if start < 0 or (most is not None and most < 1):
        raise ValueError("start must not be negative and most must be positive")
    shards = sorted(n for n in names if n.endswith(".parquet"))[start : None if most is None else start + most]
    if not shards:
        raise ValueError("no Parquet shards selected")
    return shards


def local_shards(folder: str, start: int = 0, most: int | None = None) -> list[str]:
    root = Path(folder)
    return [str(root / n) for n in select_shards([p.name for p in root.iterdir()], start, most)]


def flatten(repositories: DataFrame, languages: list[str] | None = None, dataset: str = "", shard: str | None = None) -> DataFrame:
    """One document per file that has a text, a content id and a wanted language.

    Repositories without files give nothing. order_shard, order_repo and order_file hold
    the place of a file in its source: the shard's path, the key of the repository row,
    and the index in its files. Only the fields named here are read.
    """
    source = F.lit(shard) if shard is not None else F.input_file_name()
    taken_at = [F.col("snapshot_at")] if "snapshot_at" in repositories.columns else []
    rows = repositories.select("repo_id", "repo_path", "commit_id", source.alias("source_shard"), F.xxhash64("repo_id", "commit_id", *taken_at).alias("order_repo"), F.posexplode("files").alias("order_file", "f"))
    kept = rows.where("f.content is not null and f.content <> '' and f.content_id is not null and f.content_id <> ''")
    if languages is not None:
        kept = kept.where(F.col("f.language").isin(languages))
    named = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return kept.select(
        F.concat_ws(":", named(F.col("repo_id")), named(F.col("f.file_path")), named(F.col("f.content_id"))).alias("document_id"),
        *[F.col(f"f.{c}").alias(c) for c in ("content_id", "content", "language", "file_path")],
        "repo_path",
        F.col("repo_id").cast("string").alias("repo_id"),
        "commit_id",
        F.col("f.license_type").alias("license_type"),
        F.coalesce(F.col("f.detected_licenses"), F.array().cast("array<string>")).alias("detected_licenses"),
        F.coalesce(F.col("f.is_vendor"), F.lit(False)).alias("is_vendor"),
        F.lit(dataset).alias("source_dataset"),
        "source_shard",
        F.col("source_shard").alias("order_shard"),
        "order_repo",
        "order_file",
    )


ORDER = ["order_shard", "order_repo", "order_file"]


def unique_contents(files: DataFrame) -> DataFrame:
    """The first file of each content id, in the order of the source."""
    return files.withColumn("_r", F.row_number().over(Window.partitionBy("content_id").orderBy(*ORDER))).where("_r = 1").drop("_r")


def ingest(files: DataFrame, per_repository: int = 0) -> DataFrame:
    """Documents with distinct content ids, at most per_repository of each repository row (0: no limit).

    A file past the limit of its repository does not stand in the way of its copy elsewhere.
    With a limit this is a fixed point: a file is accepted when no earlier accepted file has
    its content and fewer than per_repository files before it in its repository are accepted.
    It is reached in rounds over the keys alone; texts are joined at the end.
    """
    if per_repository < 0:
        raise ValueError("per_repository must not be negative")
    if not per_repository:
        return unique_contents(files)
    keys = cut(files.select("content_id", *ORDER))
    state = cut(keys.withColumn("accepted", F.lit(None).cast("boolean")))
    by_content = Window.partitionBy("content_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    by_repo = Window.partitionBy("order_shard", "order_repo").orderBy("order_file").rowsBetween(Window.unboundedPreceding, -1)
    while not state.where("accepted is null").isEmpty():
        open_ = lambda w: F.coalesce(F.max(F.col("accepted").isNull()).over(w), F.lit(False))
        taken = lambda w: F.coalesce(F.sum(F.when(F.col("accepted"), 1).otherwise(0)).over(w), F.lit(0))
        seen = state.withColumn("_copy", taken(by_content) > 0).withColumn("_copy_open", open_(by_content)).withColumn("_full", taken(by_repo) >= per_repository)
        waiting = F.coalesce(F.sum(F.when(F.col("accepted").isNull(), 1).otherwise(0)).over(by_repo), F.lit(0))
        seen = seen.withColumn("_may_fill", taken(by_repo) + waiting >= per_repository)
        refuse, accept = F.col("_copy") | F.col("_full"), ~F.col("_copy_open") & ~F.col("_may_fill")
        step = F.when(refuse, F.lit(False)).when(accept & ~F.col("_copy"), F.lit(True))
        state = cut(seen.withColumn("accepted", F.coalesce("accepted", step)).select("content_id", *ORDER, "accepted"))
    return files.join(state.where("accepted").select(*ORDER), ORDER, "left_semi")


def shard_prefix(counts: list[dict[str, int]], languages: list[str], least: int) -> int:
    """How many shards suffice for least documents in every language; all of them if none do."""
    have = dict.fromkeys(languages, 0)
    for used, shard in enumerate(counts, 1):
        for language, n in shard.items():
            if language in have:
                have[language] += n
        if all(n >= least for n in have.values()):
            return used
    return len(counts)


def sample_manifest(documents: DataFrame, languages: list[str], least: int) -> DataFrame:
    """language, n_documents and shortfall of every wanted language."""
    wanted = documents.sparkSession.createDataFrame([(x,) for x in sorted(set(languages))], "language string")
    counted = documents.groupBy("language").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return wanted.join(counted, "language", "left").select("language", n.alias("n_documents"), F.greatest(F.lit(0).cast("bigint"), F.lit(least).cast("bigint") - n).alias("shortfall"))
