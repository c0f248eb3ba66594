"""Drawing a sample of documents from local Parquet shards of repository snapshots."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import build_session, cut
from siltstone.sources import repositories as R
from siltstone.sources import sinks


def draw(spark: SparkSession, shards: list[str], languages: list[str], least: int = 0, per_repository: int = 0, dataset: str = "") -> tuple[DataFrame, list[str]]:
    """Documents, and the shards used: the fewest first ones that give least documents in every language.

    What a shard gives does not depend on later ones, so shards are read in prefixes of
    doubling length until one suffices; only language counts come to the driver.
    """
    many = 1 if least else len(shards)
    while True:
        files = R.flatten(spark.read.parquet(*shards[:many]), languages, dataset)
        accepted = cut(R.ingest(files, per_repository).withColumn("order_shard", F.regexp_extract("order_shard", r"([^/]+)$", 1)))
        names = {s.rsplit("/", 1)[-1]: i for i, s in enumerate(shards[:many])}
        counts: list[dict[str, int]] = [{} for _ in names]
        for r in accepted.groupBy("order_shard", "language").count().collect():
            counts[names[r["order_shard"]]][r["language"]] = r["count"]
        enough = all(sum(c.get(x, 0) for c in counts) >= least for x in languages)
        if enough or many >= len(shards):
            break
        many = min(2 * many, len(shards))
    used = shards[: R.shard_prefix(counts, languages, least)] if least else shards
    kept = accepted.where(F.col("order_shard").isin([s.rsplit("/", 1)[-1] for s in used])).drop(*R.ORDER)
    return kept, used


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(description="Draw a sample from local shards.")
    parser.add_argument("--shard-dir", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--manifest", required=True)
    parser.add_argument("--languages", nargs="+", required=True)
    parser.add_argument("--min-per-language", type=int, default=0)
    parser.add_argument("--max-per-repository", type=int, default=0)
    parser.add_argument("--max-shards", type=int)
    parser.add_argument("--start-shard", type=int, default=0)
    parser.add_argument("--dataset", default="")
    given = parser.parse_args(arguments)
    spark = spark or build_session()
    shards = R.local_shards(given.shard_dir, given.start_shard, given.max_shards)
    documents, used = draw(spark, shards, given.languages, given.min_per_language, given.max_per_repository, given.dataset)
    sinks.write_sample(documents, given.output)
    rows = R.sample_manifest(documents, given.languages, given.min_per_language).orderBy("language").collect()
    totals = documents.agg(F.count("*").alias("n_documents"), F.countDistinct("content_id").alias("unique_content_ids"))
    more = {
        "dataset": given.dataset,
        "requested_languages": given.languages,
        "min_per_language": given.min_per_language,
        "documents_by_language": {r["language"]: r["n_documents"] for r in rows},
        "shortfalls": {r["language"]: r["shortfall"] for r in rows if r["shortfall"]},
        "repositories_scanned": spark.read.parquet(*used).count(),
        "max_per_repository": given.max_per_repository or None,
        "start_shard": given.start_shard,
        "max_shards": given.max_shards,
        "shards": used,
    }
    sinks.write_manifest(totals, given.manifest, **more)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
