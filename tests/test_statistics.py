import math

import pytest
from pyspark.sql import functions as F

from siltstone.operators import statistics as S


def test_wilson(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (10, 10), (5, 10)], "s int, n int")
    got = [r[0] for r in df.select(S.wilson(F.col("s"), F.col("n"))).collect()]
    assert got[0] == [0.0, 0.0] and got[1][0] == 0.0 and got[2][1] == pytest.approx(1.0)
    assert got[3] == [pytest.approx(0.2365931), pytest.approx(0.7634069)]


def test_mcnemar():
    assert S.mcnemar_exact(0, 0) == 1.0 and S.mcnemar_exact(0, 6) == 0.03125 and S.mcnemar_exact(5, 5) == 1.0
    for b, c in ((3, 12), (40, 25), (700, 610)):
        n = b + c
        assert S.mcnemar_exact(b, c) == pytest.approx(min(1.0, 2 * sum(math.comb(n, k) for k in range(min(b, c) + 1)) / 2**n))


def test_paired(spark):
    rows = [("a", "x", True), ("a", "x", True), ("a", "y", False), ("b", "x", True), ("b", "y", True), ("c", "y", True), ("d", "x", None)]
    out = spark.createDataFrame(rows, "parent_document_id string, model string, accepted boolean")
    parents = spark.createDataFrame([(p,) for p in "aabcde"], "parent_document_id string")
    row = S.compare(S.paired_outcomes(parents, out, "x", "y")).first()
    assert (row["attempted"], row["both_succeeded"], row["first_only"], row["second_only"], row["neither"]) == (5, 1, 1, 1, 2)
    assert row["rate_difference"] == 0.0 and row["p_value"] == 1.0 and row["clear_difference"] is False
    empty = S.paired_outcomes(parents.limit(0), out.limit(0), "x", "y").first()
    assert empty["attempted"] == 0


def test_upper_median(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4), ("a", 2), ("a", 3), ("b", 5), ("c", None)], "k string, v int")
    assert {r["k"]: r["m"] for r in df.groupBy("k").agg(S.upper_median("v").alias("m")).collect()} == {"a": 3, "b": 5, "c": None}


def test_manifest(spark):
    organic = spark.createDataFrame([("a b", None), ("c", 7)], "content string, token_count int")
    made = spark.createDataFrame([("m", "codetrace", "x y z"), ("m", "codedev", "x")], "model string, method string, content string")
    row = S.manifest(organic, made, 1).first()
    assert row["organic_token_count"] == 9 and row["synthetic_token_count"] == 4 and row["total_documents"] == 4
    assert row["base_synthetic_target_documents"] == 3 and row["base_synthetic_shortfall_documents"] == 2 and row["codetrace_pilot_shortfall_documents"] == 1
    assert row["synthetic_by_model_method"] == {"m/codetrace": 1, "m/codedev": 1} and row["status"] == "completed_with_shortfalls"
    assert S.manifest(organic.limit(0), made.limit(0), 0).first()["status"] == "completed"


def test_unique_repositories(spark):
    df = spark.createDataFrame([("1", "p"), ("", "p"), (None, "q"), (None, None), (None, None)], "repo_id string, repo_path string")
    assert S.unique_repositories(df).first()["n_repositories"] == 4
    assert S.sampling_is_enough(1000, 200) and not S.sampling_is_enough(1000, 199)
