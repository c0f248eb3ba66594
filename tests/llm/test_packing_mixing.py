import math
import random

import pytest
from pyspark.sql import functions as F

from siltstone.llm import mixing, packing
from siltstone.session import cut


def documents(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choices(["a", "b", "c", None], [6, 3, 1, 0.2])[0], rng.choice([1, 5, 40, 90, 200, 700, 3000]) + rng.randrange(30)) for i in range(n)]
    return spark.createDataFrame([*rows, (n, "a", 0), (n + 1, "b", None)], "doc_id bigint, source string, n_tokens bigint")


@pytest.mark.parametrize("group_tokens", [10**9, 20_000])
def test_packing_is_whole_and_tight(spark, group_tokens):
    df = documents(spark)
    packs = spark.createDataFrame([("s", 512), ("l", 2048), ("bad", 0), (None, 5), ("s", 512)], "pack_name string, capacity_tokens int")
    out = packing.pack(df, packs, cut, group_tokens=group_tokens).cache()
    total = df.agg(F.sum("n_tokens")).first()[0]
    assert {r["pack_name"]: r["t"] for r in out.groupBy("pack_name").agg(F.sum("n_tokens").alias("t")).collect()} == {"s": total, "l": total}
    assert out.count() == out.select("pack_name", "doc_id", "piece_no").distinct().count()
    per = out.groupBy("pack_name", "capacity", "container_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("offset") + F.col("n_tokens")).alias("end"), F.count_if(F.col("offset") == 0).alias("first"))
    assert per.where("n > capacity OR end <> n OR first <> 1").count() == 0
    cuts = out.join(df.select("doc_id", F.col("n_tokens").alias("whole")), "doc_id").groupBy("pack_name", "capacity", "doc_id", "whole").count()
    assert cuts.where("count > 1 AND whole <= capacity").count() == 0 and cuts.where("count <> ceil(whole / capacity)").count() == 0
    report = {r["pack_name"]: r for r in packing.fill_report(out).collect()}
    assert min(r["fill"] for r in report.values()) > 0.98


def test_null_and_large_ids(spark):
    rows = [(None, "a", 5), (None, "a", 5), (2**62 + 1, "a", 7), (7, None, 600)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    out = packing.pack(df, spark.createDataFrame([("s", 512)], "pack_name string, capacity_tokens int"), cut)
    got = sorted((r["doc_id"] or 0, r["piece_no"], r["n_tokens"]) for r in out.collect())
    assert got == [(0, 0, 5), (0, 0, 5), (7, 0, 512), (7, 1, 88), (2**62 + 1, 0, 7)]


def _groups(out):
    """Tokens and rows per pack and group of each level."""
    parts = out.withColumn("g", F.regexp_extract("container_id", r"^(\d+-\d+)-", 1))
    return parts.groupBy("pack_name", "g").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).collect()


def test_no_group_grows_beyond_its_bound(spark):
    """Items of which no two fit one container: nothing is gained by carrying all of them on."""
    df = spark.range(20_000).selectExpr("id as doc_id", "'a' as source", "600L as n_tokens")
    packs = spark.createDataFrame([("s", 1000)], "pack_name string, capacity_tokens int")
    out = packing.pack(df, packs, cut, group_tokens=200_000).cache()
    assert out.count() == 20_000 and max(r["n"] for r in _groups(out)) < 300_000
    assert out.where("container_id like '2-%'").count() < 1_000


def test_null_ids_are_spread(spark):
    df = spark.range(20_000).selectExpr("cast(null as bigint) as doc_id", "if(id % 3 = 0, 'a', 'b') as source", "cast(20 + id % 170 as bigint) as n_tokens")
    packs = spark.createDataFrame([("s", 1000)], "pack_name string, capacity_tokens int")
    out = packing.pack(df, packs, cut, group_tokens=200_000).cache()
    assert out.count() == 20_000 and out.where("doc_id is not null").count() == 0
    assert max(r["n"] for r in _groups(out)) < 300_000
    assert packing.fill_report(out).first()["fill"] > 0.98


def test_many_packs(spark, monkeypatch):
    monkeypatch.setattr(packing, "PACKS_AT_ONCE", 2)
    df = documents(spark, 60)
    packs = spark.createDataFrame([(f"p{i}", 500 + i) for i in range(5)], "pack_name string, capacity_tokens int")
    out = packing.pack(df, packs, cut)
    total = df.agg(F.sum("n_tokens")).first()[0]
    assert {r[0]: r[1] for r in out.groupBy("pack_name").agg(F.sum("n_tokens")).collect()} == {f"p{i}": total for i in range(5)}


def test_windows_meet_the_shares(spark):
    df = spark.range(9_000).selectExpr("id as doc_id", "case when id % 10 < 6 then 'a' when id % 10 < 9 then 'b' end as source", "cast(20 + (id * 7919) % 180 as bigint) as n_tokens")
    packs = spark.createDataFrame([("s", 2048)], "pack_name string, capacity_tokens int")
    out = packing.pack(df, packs, cut, group_tokens=400_000).cache()
    report = packing.window_shares(out).collect()
    whole = {}
    for r in report:
        whole[r["window_id"]] = whole.get(r["window_id"], 0) + r["n_tokens"]
    full = [r for r in report if r["window_id"].startswith("0-") and whole[r["window_id"]] > 0.95 * 2048 * packing.WINDOW]
    assert len(full) > 30 and max(abs(r["share"] - r["target_share"]) for r in full) < 0.05


def test_limits_report(spark):
    df = documents(spark)
    texts = df.withColumn("text", F.when(F.col("n_tokens") > 0, F.lit("x")))
    packs = spark.createDataFrame([("s", 512), ("l", 2048)], "pack_name string, capacity_tokens int")
    out = packing.pack(df, packs, cut)
    got = {r["pack_name"]: tuple(r)[1:] for r in packing.limits_kept(texts, out).collect()}
    assert got == {"s": (600, 0, 0, 0, 0), "l": (600, 0, 0, 0, 0)}
    broken = out.unionByName(out.where("doc_id = 3"))
    assert all(r["twice"] > 0 for r in packing.limits_kept(texts, broken).collect())


def test_packing_without_items(spark):
    df = documents(spark).limit(0)
    packs = spark.createDataFrame([("s", 512)], "pack_name string, capacity_tokens int")
    assert packing.pack(df, packs, cut).count() == 0
    assert packing.pack(documents(spark), packs.limit(0), cut).count() == 0


def test_round_robin_keeps_the_shares():
    rng = random.Random(3)
    items = {s: [(rng.randrange(20, 200), i, 0) for i in range(n)] for s, n in (("a", 900), ("b", 300))}
    sizes = {s: sum(x[0] for x in own) for s, own in items.items()}
    shares = {s: v / sum(sizes.values()) for s, v in sizes.items()}
    got = {"a": 0, "b": 0}
    for n, (_, content) in enumerate(packing.pack_group(items, 1024, shares, {})):
        for source, size, *_ in content:
            got[source] += size
        if 10 <= n <= 80:
            assert abs(got["a"] / sum(got.values()) - shares["a"]) < 0.08
    assert got == sizes


def test_poisson_thresholds():
    t = mixing.thresholds(1.5, 4)
    assert t == pytest.approx([sum(math.exp(-1.5) * 1.5**j / math.factorial(j) for j in range(k + 1)) for k in range(4)])


TARGETS = [("m", "A", 0.5, 1), ("m", " a ", 0.0, 1), ("m", "b", 0.3, 2), ("m", "C", 0.2, 4), ("n", "c", 0.6, 3), ("n", "none", 0.4, 2)]


def test_mix_meets_targets(spark):
    df = documents(spark, 4000)
    targets = spark.createDataFrame(TARGETS, "mix_name string, source string, target_share double, max_repeats int")
    planned = mixing.plan(df, targets)
    report = {(r["mix_name"], r["source"]): r for r in mixing.shares(df, planned).collect()}
    for key, want in ((("m", "a"), 0.5), (("m", "b"), 0.3), (("m", "c"), 0.2), (("n", "c"), 1.0), (("n", "none"), 0.0)):
        assert report[key]["reached_share"] == pytest.approx(want, abs=0.01)
        assert report[key]["most_copies"] <= report[key]["max_repeats"]
    rows = mixing.mix(df, planned).collect()
    copies = {}
    for r in rows:
        copies.setdefault((r["mix_name"], r["doc_id"]), []).append(r["copy_no"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in copies.values())
    assert sum(r["n_tokens"] for r in rows if r["mix_name"] == "m" and r["source"] == "b") == report["m", "b"]["tokens"]
    order = [r["order_key"] for r in rows if r["mix_name"] == "m"]
    assert order == sorted(order)
    again = [tuple(r) for r in mixing.mix(df.repartition(7), mixing.plan(df.repartition(3), targets)).collect()]
    assert sorted(again) == sorted(tuple(r) for r in rows)


def test_mix_of_nothing(spark):
    df = documents(spark)
    targets = spark.createDataFrame(TARGETS, "mix_name string, source string, target_share double, max_repeats int")
    assert mixing.mix(df.limit(0), mixing.plan(df.limit(0), targets)).count() == 0
    assert mixing.mix(df, mixing.plan(df, targets.limit(0))).count() == 0


def test_clean_source(spark):
    df = spark.createDataFrame([(" Issue_Threads ",), ("ISSUE-THREADS",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(mixing.clean_source(F.col("s"))).collect()] == ["issue-threads", "issue-threads", None, None]


def test_a_long_plan_is_joined(spark, monkeypatch):
    df = documents(spark, 2000)
    targets = spark.createDataFrame(TARGETS, "mix_name string, source string, target_share double, max_repeats int")
    usual = sorted(tuple(r) for r in mixing.mix(df, mixing.plan(df, targets)).collect())
    monkeypatch.setattr(mixing, "SENT_TARGETS", 1)
    assert sorted(tuple(r) for r in mixing.mix(df, mixing.plan(df, targets)).collect()) == usual


def test_a_turned_histogram_is_that_of_shifted_numbers(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "'a' as source", "cast(1 + id % 50 as bigint) as n_tokens")
    targets = spark.createDataFrame([("m", "a", 1.0, 3)], "mix_name string, source string, target_share double, max_repeats int")
    planned = mixing.plan(df, targets, total_tokens=90_000.0)
    row = planned.first()
    assert planned.count() == 1 and row["target_tokens"] == 90_000.0
    got = mixing.shares(df, planned).first()
    assert abs(got["tokens"] - 90_000) < 200
