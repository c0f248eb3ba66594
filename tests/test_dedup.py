import random

import pytest

from siltstone.operators import dedup
from siltstone.operators import decontaminate as D
from siltstone.plans.pipeline import Options
from tests.test_text import py_shingles, py_tokens


def jaccard(a, b):
    x, y = py_shingles(py_tokens(a)), py_shingles(py_tokens(b))
    return len(x & y) / max(1, len(x | y))


def corpus(n=60, seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 60))] for _ in range(8)]
    out = []
    for _ in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    return out + ["", "", "x", "x y", "same  text", "same text"]


def greedy(texts, threshold):
    kept = []
    for i, t in enumerate(texts):
        if not any(jaccard(t, texts[k]) >= threshold for k in kept):
            kept.append(i)
    return kept


def test_exact_first_wins_and_nulls_stay(spark):
    rows = [(2, "a"), (1, "a"), (3, None), (4, None), (5, "b"), (6, ""), (7, "")]
    out = dedup.exact_deduplicate(spark.createDataFrame(rows, "i int, content string"), ["i"])
    assert sorted(r["i"] for r in out.collect()) == [1, 3, 4, 5, 6]
    assert dedup.exact_deduplicate(spark.createDataFrame([], "i int, content string"), ["i"]).count() == 0


def test_exact_ties_repeats_and_null_order(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (2, "a", "y"), (None, "b", "p"), (None, "b", "q"), (3, "b", "r"), (None, None, "n"), (None, None, "n"), (4, "c", "z")] + [(5, "d", str(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "i int, content string, more string")
    out = dedup.exact_deduplicate(df, ["i"]).collect()
    assert sorted((r["content"] or "", r["i"] or 0) for r in out) == [("", 0), ("", 0), ("a", 1), ("b", 0), ("c", 4), ("d", 5)]
    assert dedup.exact_deduplicate(df, ["i"]).columns == ["i", "content", "more", "content_hash"]


def test_exact_with_one_hot_text(spark):
    df = spark.range(3000).selectExpr("id AS i", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS content")
    assert dedup.exact_deduplicate(df, ["i"]).count() == 2001


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.7, 0.92])
def test_pairs_and_greedy_against_brute_force(spark, threshold):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    pairs = {(r["a"], r["b"]) for r in dedup.similar_pairs(dedup.keyed(df, "i"), threshold).collect()}
    assert pairs == {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if jaccard(texts[i], texts[j]) >= threshold}
    kept = sorted(r["i"] for r in dedup.near_deduplicate(df, "i", threshold).collect())
    assert kept == greedy(texts, threshold)


def test_near_dedup_of_an_empty_table(spark):
    assert dedup.near_deduplicate(spark.createDataFrame([], "i int, content string"), "i").count() == 0


def test_default_threshold(spark):
    words = [f"w{i}" for i in range(40)]
    first, near = " ".join(words), " ".join([*words[:-4], "a", "b", "c", "d"])
    assert 0.8 <= jaccard(first, near) < dedup.REFERENCE_THRESHOLD
    organic = spark.createDataFrame([(1, first)], "id int, content string")
    made = spark.createDataFrame([(2, near)], "id int, content string")
    assert [r["rejection_reason"] is None for r in dedup.cross_deduplicate(organic, made, "id").collect()] == [False]
    assert [r["rejection_reason"] is None for r in dedup.cross_deduplicate(organic, made, "id", dedup.REFERENCE_THRESHOLD).collect()] == [True]
    both = organic.union(made)
    assert dedup.near_deduplicate(both, "id").count() == 1
    assert dedup.near_deduplicate(both, "id", dedup.REFERENCE_THRESHOLD).count() == 2
    assert Options().threshold == dedup.THRESHOLD


def test_cross_dedup_against_brute_force(spark):
    texts = corpus(40, 9)
    organic, made = texts[:15], texts[15:]
    a = spark.createDataFrame([(f"o{i:02}", t) for i, t in enumerate(organic)], "id string, content string")
    b = spark.createDataFrame([(f"s{i:02}", t) for i, t in enumerate(made)], "id string, content string")
    got = {r["id"] for r in dedup.cross_deduplicate(a, b, "id", 0.6).where("rejection_reason is null").collect()}
    norm = lambda t: " ".join(t.split())
    kept = []
    for i, t in enumerate(made):
        known = organic + [made[k] for k in kept]
        if not any(norm(t) == norm(x) or jaccard(t, x) >= 0.6 for x in known):
            kept.append(i)
    assert got == {f"s{i:02}" for i in kept}


EVAL = ["short text", "a passage of evaluation text that is longer than forty characters", "x" * 39, "y" * 40, None, "  "]


@pytest.mark.parametrize("block", [8_000_000, 1])
def test_decontamination_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_CHARACTERS", block)
    texts = ["short text", "has short text inside", "pre a passage  of evaluation\ntext that is longer than forty characters post", "A passage of evaluation text that is longer than forty characters", "x" * 39, "z" + "x" * 39, "z" + "y" * 41, None, "", " short   text "]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    evaluation = spark.createDataFrame([(t,) for t in EVAL], "content string")
    out = {r["i"]: r["rejection_reason"] for r in D.decontaminate(docs, evaluation, "i").collect()}
    assert {i for i, r in out.items() if r == D.REASON} == {0, 2, 4, 6, 9} and len(out) == len(texts)
    assert D.drop_evaluation_matches(docs, evaluation, "i").count() == len(texts) - 5
    assert D.drop_evaluation_matches(docs, evaluation.limit(0), "i").count() == len(texts)


def test_parts_against_plain_search():
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("ab c") for _ in range(n))
    head = line(60)
    texts = [head + line(rng.choice([0, 5, 80])) for _ in range(30)] + [line(rng.choice([3, 39, 40, 41, 200])) for _ in range(30)]
    index = D.PartIndex(texts)
    for _ in range(300):
        t = line(rng.randrange(90))
        if rng.random() < 0.5:
            part = rng.choice(texts)
            part = part if rng.random() < 0.7 else part[: rng.randrange(1, len(part) + 1)]
            at = rng.randrange(len(t) + 1)
            t = t[:at] + part + t[at:]
        assert index.held(t) == (t in texts or any(len(x) >= 40 and x in t for x in texts)), t


def test_rolling_hashes_are_those_of_the_runs():
    text = "añ🐛b" * 40
    hashes = D.run_hashes(text)
    assert len(hashes) == len(text) - 39
    assert all(int(D.run_hashes(text[i : i + 40])[0]) == int(h) for i, h in enumerate(hashes))


def test_no_cross_join_in_decontamination(spark):
    docs = spark.createDataFrame([(1, "x")], "i int, content string")
    out = D.decontaminate(docs, spark.createDataFrame([(t,) for t in EVAL], "content string"), "i")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
