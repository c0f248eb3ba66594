from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators import quotas

SCHEMA = "n int, document_id string, content string, language string, repo_id string, repo_path string"


def documents(spark, languages, repos=None):
    rows = [(i, f"d{i:03}", f"text {i}", lang, (repos or {}).get(i, f"r{i % 7}"), "p") for i, lang in enumerate(languages)]
    return spark.createDataFrame(rows, SCHEMA)


def expected_selection(languages, branch):
    """Documents of a base branch by stepping through the languages one after the other."""
    n = len(languages)
    total = round(1.5 * n)
    quota = total // 6 + (branch < total % 6)
    counts = Counter(languages)
    share = {x: quota * c // n for x, c in counts.items()}
    for x in sorted(counts, key=lambda x: (-(quota * counts[x] % n), x))[: quota - sum(share.values())]:
        share[x] += 1
    own = {x: [i for i, y in enumerate(languages) if y == x] for x in counts}
    out, turn = [], 0
    while len(out) < quota:
        for x in sorted(counts):
            if turn < min(share[x], len(own[x])) and len(out) < quota:
                out.append(own[x][turn])
        turn += 1
    return out


@pytest.mark.parametrize("n", [0, 1, 3, 7, 20, 101])
def test_quota_sums(spark, n):
    got = [r["quota"] for r in quotas.quotas(spark.range(n)).orderBy("branch").collect()]
    total = round(1.5 * n)
    assert got == [total // 6 + (i < total % 6) for i in range(6)]


@pytest.mark.parametrize("languages", [["Python", "Go"] * 10, ["Python"] * 90 + ["Go"] * 10, ["C", "C", "Ada", "B", "Ada", "C", "C"], ["X"]])
def test_selection_agrees_with_stepping(spark, languages):
    out = quotas.base_parents(documents(spark, languages), ["n"]).collect()
    for i, (model, method) in enumerate(quotas.BASE_BRANCHES):
        got = [r["n"] for r in sorted(out, key=lambda r: r["place"]) if (r["model"], r["method"]) == (model, method)]
        assert got == expected_selection(languages, i)


def test_ninety_to_ten(spark):
    out = quotas.base_parents(documents(spark, ["Python"] * 90 + ["Go"] * 10), ["n"]).where("model = 'qwen_coder' and method = 'swallowcode'")
    assert {r["language"]: r["count"] for r in out.groupBy("language").count().collect()} == {"Python": 22, "Go": 3}


def test_null_language_and_clashing_columns(spark):
    df = documents(spark, ["Go", None, None, "Go"]).withColumn("place", F.lit("x")).withColumn("model", F.lit(1))
    out = quotas.base_parents(df, ["n"])
    assert out.count() == round(1.5 * 4) and dict(out.dtypes)["place"] == "int"
    assert quotas.base_parents(df.limit(0), ["n"]).count() == 0


def test_cohort_takes_turns(spark):
    repos = {0: "b", 1: "b", 2: "a", 3: "", 4: None, 5: "b"}
    df = documents(spark, ["Python", "python", "PYTHON", "Python", "Go", "Python"], repos)
    got = [r["document_id"] for r in quotas.cohort(df, ["n"], 10).orderBy("place").collect()]
    assert got == ["d002", "d000", "d003", "d001", "d005"]  # a, b and the repository path p take turns
    assert quotas.cohort(df, ["n"], 2).count() == 2 and quotas.cohort(df, ["n"], 0).count() == 0
    with pytest.raises(ValueError):
        quotas.cohort(df, ["n"], -1)
