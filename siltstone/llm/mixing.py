"""Mixing sources to target shares by Poisson replication.

Every document of a mix has a uniform number made from a hash of its id. The
number of its copies is the inverse of a Poisson distribution at that number,
cut off at the allowed repeats. The mean of the distribution is solved for each
source so that the tokens drawn meet the target: as the numbers are fixed, the
tokens at every mean follow from one histogram of tokens over the numbers. The
same histogram, turned by a part of its length, belongs to the numbers shifted by
as much: each shift is another draw of the source, and the one that meets its
target best is taken.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import cut, ensure_importable

#: Parts of the unit interval the tokens of a source are counted in, shifts tried for each source (a divisor of BINS),
#: rows of a plan up to which it is sent to the documents (else it is joined).
BINS, SHIFTS, SENT_TARGETS = 2048, 8, 10_000
SEED = 7
#: Salts over which the rows of one source are spread where a plan is joined.
SALTS = 64
#: Share of the largest total that the scarcest source allows.
FILL = 0.95
PLAN = "mix_name string, source string, target_share double, max_repeats int, source_docs bigint, source_tokens bigint, target_tokens double, shift double, mean double, thresholds array<double>"


def clean_source(source: Column) -> Column:
    """Lower case, blanks cut off, underscores and inner blanks as hyphens; empty names are null."""
    name = F.regexp_replace(F.lower(F.trim(source)), r"[_\s]+", "-")
    return F.when(name != "", name)


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) from a hash of the seed and the keys."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *keys), 11).cast("double") / float(1 << 53)


def thresholds(mean: float, repeats: int) -> list[float]:
    """Numbers from which a document gets 1, 2, ... repeats copies: the Poisson distribution function below each."""
    out, term, total = [], math.exp(-mean), 0.0
    for k in range(repeats):
        total += term
        out.append(min(total, 1.0))
        term *= mean / (k + 1)
    return out


def drawn(mean: float, repeats: int, tail: list[float]) -> float:
    """Tokens drawn at a mean; tail[i] are the tokens at numbers of i / BINS or more."""
    out = 0.0
    for x in thresholds(mean, repeats):
        at = min(x, 1.0) * (len(tail) - 1)
        i = min(int(at), len(tail) - 2)
        out += tail[i] + (tail[i + 1] - tail[i]) * (at - i)
    return out


def solve_mean(target: float, repeats: int, tail: list[float]) -> float:
    """The mean at which the tokens drawn meet the target, by bisection; they grow with the mean."""
    if target <= 0 or tail[0] <= 0:
        return 0.0
    low, high = 0.0, 1.0
    while drawn(high, repeats, tail) < target and high < 700:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        if drawn(middle, repeats, tail) < target:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _options(row: dict, bins: list[int], amounts: list[int]) -> list[dict]:
    """For each shift the mean and the thresholds that meet the target of one source."""
    out = []
    for k in range(SHIFTS):
        tail = [0.0] * (BINS + 1)
        for i, n in zip(bins, amounts, strict=True):
            tail[(i + k * BINS // SHIFTS) % BINS] = float(n)
        for i in range(BINS - 1, -1, -1):
            tail[i] += tail[i + 1]
        mean = solve_mean(row["target_tokens"], row["max_repeats"], tail)
        out.append(row | {"shift": k / SHIFTS, "mean": mean, "thresholds": thresholds(mean, row["max_repeats"])})
    return out


def _solve(data: pd.DataFrame) -> pd.DataFrame:
    """The options of one mix and source; data has a row per bin."""
    names = [c.split()[0] for c in PLAN.split(", ")]
    row = {c: data[c].iloc[0] for c in names[:7]}
    row["max_repeats"], row["target_tokens"] = int(row["max_repeats"]), float(row["target_tokens"])
    known = data[data["bin"].notna()]
    if row["target_tokens"] <= 0 or known.empty:
        return pd.DataFrame([row | {"shift": 0.0, "mean": 0.0, "thresholds": []}], columns=names)
    return pd.DataFrame(_options(row, known["bin"].astype(int).tolist(), known["n"].astype(int).tolist()), columns=names)


def plan(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, fill: float = FILL) -> DataFrame:
    """One row per mix and source: what there is, the target, the shift, the mean and the thresholds of the copies.

    documents: doc_id, source, n_tokens. targets: mix_name, source, target_share, max_repeats;
    repeated targets of a source add up. The total of a mix is total_tokens, or fill of the
    largest one at which no source needs more than its repeats. Shares of sources without
    tokens go to the others in proportion. The documents are counted once, into at most BINS
    numbers per target, and each target is solved in a task of its own; then one more pass
    counts exactly what each shift would draw.
    """
    ensure_importable(documents.sparkSession)
    named = targets.select("mix_name", clean_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("mix_name is not null and source is not null")
    wanted = cut(named.groupBy("mix_name", "source").agg(F.coalesce(F.sum("target_share"), F.lit(0.0)).alias("target_share"), F.coalesce(F.max("max_repeats"), F.lit(0)).cast("int").alias("max_repeats")))
    keys = wanted.select("mix_name", "source")
    placed = _meet(documents, keys)
    bins = cut(placed.groupBy("mix_name", "source", F.floor(uniform(F.col("mix_name"), F.col("doc_id")) * BINS).cast("int").alias("bin")).agg(F.sum("n_tokens").cast("bigint").alias("n"), F.count("*").alias("docs")))
    there = bins.groupBy("mix_name", "source").agg(F.sum("n").alias("source_tokens"), F.sum("docs").alias("source_docs"))
    zero = F.lit(0).cast("bigint")
    known = wanted.join(there, ["mix_name", "source"], "left").withColumns({"source_tokens": F.coalesce("source_tokens", zero), "source_docs": F.coalesce("source_docs", zero)})
    present = (F.col("source_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    most = F.min(F.when(present, F.col("source_tokens") * F.col("max_repeats") / F.col("target_share")))
    whole = known.groupBy("mix_name").agg(F.coalesce(F.sum(F.when(present, F.col("target_share"))), F.lit(0.0)).alias("_whole"), F.coalesce(most, F.lit(0.0)).alias("_most"))
    total = F.lit(float(total_tokens)) if total_tokens is not None else fill * F.col("_most") * F.col("_whole")
    want = F.when(present, total * F.col("target_share") / F.col("_whole")).otherwise(F.lit(0.0))
    known = known.join(whole, "mix_name").withColumn("target_tokens", want)
    rows = known.join(bins.select("mix_name", "source", "bin", "n"), ["mix_name", "source"], "left")
    options = cut(rows.select(*[c.split()[0] for c in PLAN.split(", ")][:7], "bin", "n").groupBy("mix_name", "source").applyInPandas(_solve, PLAN))
    several = options.where("target_tokens > 0").groupBy("mix_name", "source").agg(F.sort_array(F.collect_list(F.struct("shift", "thresholds"))).alias("options"))
    tried = _meet(documents, several)
    draws = [F.sum(F.col("n_tokens") * _copies(F.col("options")[k]["shift"], F.col("options")[k]["thresholds"])).alias(f"d{k}") for k in range(SHIFTS)]
    exact = tried.groupBy("mix_name", "source").agg(*draws).select("mix_name", "source", F.array(*[f"d{k}" for k in range(SHIFTS)]).alias("drawn"))
    joined = options.join(exact, ["mix_name", "source"], "left")
    drawn = F.coalesce(F.get("drawn", F.bround(F.col("shift") * SHIFTS).cast("int")), F.lit(0))
    parts = [c.split()[0] for c in PLAN.split(", ")][2:]
    best = joined.groupBy("mix_name", "source").agg(F.min_by(F.struct(*parts), F.struct(F.abs(drawn - F.col("target_tokens")), "shift")).alias("x"))
    return cut(best.select("mix_name", "source", "x.*"))


def _meet(documents: DataFrame, planned: DataFrame) -> DataFrame:
    """Documents with tokens beside each row of planned for their source.

    A plan of at most SENT_TARGETS rows (it is counted) is sent to the documents; a longer one
    is repeated for each of SALTS salts and joined, so that no source meets it in one task.
    """
    own = documents.where("n_tokens > 0 and source is not null").select("doc_id", "source", "n_tokens")
    if planned.limit(SENT_TARGETS + 1).count() <= SENT_TARGETS:
        return own.join(F.broadcast(planned), "source")
    salted = planned.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return own.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["source", "_salt"]).drop("_salt")


def _copies(shift: Column, steps: Column) -> Column:
    own = uniform(F.col("mix_name"), F.col("doc_id")) + shift
    own = own - F.floor(own)
    return F.size(F.filter(steps, lambda x: own >= x))


def counted(documents: DataFrame, planned: DataFrame) -> DataFrame:
    """documents of each mix with n_copies, 0 for those not drawn."""
    met = _meet(documents, planned.select("mix_name", "source", "shift", "thresholds"))
    return met.select("mix_name", "doc_id", "source", "n_tokens", _copies(F.col("shift"), F.col("thresholds")).alias("n_copies"))


def mix(documents: DataFrame, planned: DataFrame) -> DataFrame:
    """The selection: one row per copy, in a global order by hash within each mix."""
    copies = counted(documents, planned).where("n_copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    order = F.xxhash64(F.lit(11), "mix_name", "doc_id", "copy_no")
    return copies.drop("n_copies").withColumn("order_key", order).orderBy("mix_name", "order_key")


def shares(documents: DataFrame, planned: DataFrame) -> DataFrame:
    """The shares reached, one row per mix and source of the plan."""
    got = counted(documents, planned).groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("n_copies")).alias("tokens"), F.sum("n_copies").alias("n_rows"), F.max("n_copies").alias("most_copies"))
    totals = got.groupBy("mix_name").agg(F.sum("tokens").alias("all_tokens"))
    joined = planned.join(got, ["mix_name", "source"], "left").join(F.broadcast(totals), "mix_name", "left")
    reached = F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select("mix_name", "source", "target_share", reached.alias("reached_share"), zero("tokens"), zero("n_rows"), zero("most_copies"), "max_repeats", "source_docs", "source_tokens", "mean")


def limits_kept(documents: DataFrame, planned: DataFrame) -> DataFrame:
    """Per mix and source: documents there are, those drawn more often than allowed, and copies drawn without a target.

    The last two are 0 where the selection kept to its targets.
    """
    drawn = counted(documents, planned).join(F.broadcast(planned.select("mix_name", "source", "max_repeats", "target_share")), ["mix_name", "source"])
    per = drawn.groupBy("mix_name", "source").agg(F.count_if(F.col("n_copies") > F.col("max_repeats")).alias("over"), F.sum(F.when(F.coalesce(F.col("target_share") > 0, F.lit(False)), 0).otherwise(F.col("n_copies"))).alias("unasked"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return planned.select("mix_name", "source", "max_repeats", "source_docs").join(per, ["mix_name", "source"], "left").select("mix_name", "source", "max_repeats", "source_docs", zero("over"), zero("unasked"))
