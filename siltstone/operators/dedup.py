"""Exact and near duplicates; of equal or similar texts the first one in the order of input stays."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.session import cut, ensure_importable, sent_if_small, spread, stored

#: Similarity from which texts are near duplicates, and that of the reference for those who ask for it.
THRESHOLD, REFERENCE_THRESHOLD = 0.8, 0.92
SALTS = 32
#: One text in COMMON_SAMPLE, chosen by hash, shows which shingles are common: those in COMMON_FROM of them or more, at
#: most MOST_COMMON. Only the order of shingles, and so the speed, depends on it, never the result.
COMMON_SAMPLE, COMMON_FROM, MOST_COMMON = 8, 2, 400_000
_EPS = 1e-9
_TOKEN = re.compile(r"\w+|[^\w\s]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def exact_deduplicate(documents: DataFrame, order: list[str], content: str = "content") -> DataFrame:
    """The first row of each distinct text, with content_hash. Rows without a text all stay.

    order: columns that give the order of input; of rows that agree in them one stays. Only
    hashes and order are shuffled to find the rows that go, and those, as a rule few, are
    taken out of the documents by a join they are sent to while they are few. A text that a third of all rows share is no hot group: its rows are ranked within
    salted keys first, and only the first of each salt meet.
    """
    key = [F.xxhash64(F.lit(seed), "content_hash", *order).alias(f"_k{seed}") for seed in (1, 2)]
    hashed = documents.drop("content_hash").withColumn("content_hash", T.content_hash(F.col(content)))
    slim = hashed.where("content_hash is not null").select("content_hash", F.struct(*order).alias("o"), *key, F.pmod(F.xxhash64(*order), F.lit(SALTS)).alias("salt"))
    part = Window.partitionBy("content_hash", "salt").orderBy("o")
    ranked = slim.withColumn("a", F.row_number().over(part)).withColumn("tie", (F.col("a") > 1) & (F.col("_k1") == F.first("_k1").over(part)) & (F.col("_k2") == F.first("_k2").over(part)))
    firsts = Window.partitionBy("content_hash", F.when(F.col("a") == 1, SALTS).otherwise(F.col("salt"))).orderBy("o")
    judged = ranked.withColumn("b", F.row_number().over(firsts)).where("a > 1 OR b > 1").select("content_hash", "_k1", "_k2", "tie")
    losers = stored(judged)
    gone = sent_if_small(losers.where("not tie").select("_k1", "_k2").distinct())
    kept = hashed.withColumns({"_k1": key[0], "_k2": key[1]}).join(gone, ["_k1", "_k2"], "left_anti")
    tied = losers.where("tie").select("content_hash").distinct()
    if not tied.isEmpty():  # rows that agree in text and order: any one of them
        kept = kept.join(tied, "content_hash", "left_anti").unionByName(kept.join(tied, "content_hash", "left_semi").dropDuplicates(["content_hash"]))
    return kept.select(*[c for c in documents.columns if c != "content_hash"], "content_hash")


def keyed(documents: DataFrame, key: str, content: str = "content") -> DataFrame:
    """key and text of the rows with a text: a null text is like no other."""
    return documents.where(F.col(content).isNotNull()).select(F.col(key).alias("key"), F.col(content).alias("text"))


def prefix_length(n: int, threshold: float) -> int:
    """Shingles, in any fixed order, among which any partner of the threshold shares one."""
    return n - math.ceil(n * threshold - _EPS) + 1


class Hasher:
    """Distinct 64-bit hashes of the shingles of texts, sorted; remembers the hashes of tokens."""

    def __init__(self):
        self.memory: dict[str, int] = {}

    def _token(self, t: str) -> int:
        if len(self.memory) > 500_000:
            self.memory.clear()
        digest = hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        h = self.memory[t] = int.from_bytes(digest, "little")
        return h

    def hashes(self, text: str) -> np.ndarray:
        """Fewer tokens than a shingle has are one run; no tokens are the empty run."""
        tokens, size = _TOKEN.findall(text), T.SHINGLE_TOKENS
        known, make = self.memory.get, self._token
        of = np.array([known(t) or make(t) for t in tokens], np.uint64)
        with np.errstate(over="ignore"):
            if len(of) < size:
                h = np.full(1, len(of), np.uint64)
                for x in of:
                    h = h * _BASE + x
            else:
                h = of[: len(of) - size + 1]
                for k in range(1, size):
                    h = h * _BASE + of[k : len(of) - size + 1 + k]
            # spreads the sums over all numbers, so that their order is no order of texts
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
        return np.unique(h.view(np.int64))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts) if parts else np.zeros(0), type=kind))


def _hashed(texts: DataFrame, threshold: float | None = None, common: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """id, side, n, s of each text: all its hashes, or with a threshold those of its prefix, the more common ones last."""
    ensure_importable(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast(common or (np.zeros(0, np.int64), np.zeros(0, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (late, times) = Hasher(), sent.value
        for batch in batches:
            lists, sizes = [], []
            for text in batch.column(2).to_pylist():
                h = hasher.hashes(text)
                sizes.append(len(h))
                if threshold is not None:
                    if len(late):
                        at = np.searchsorted(late, h)
                        at[at == len(late)] = 0
                        h = h[np.argsort(np.where(late[at] == h, times[at], 0), kind="stable")]
                    h = h[: prefix_length(len(h), threshold)]
                lists.append(h)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), _lists(lists, pa.int64())], names=["id", "side", "n", "s"])

    return texts.select(F.xxhash64("key").alias("id"), "side", "text").mapInArrow(run, "id bigint, side int, n int, s array<bigint>")


def _common(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles in order of their hashes, and how often each was seen."""
    some = _hashed(texts.where(F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(COMMON_SAMPLE)) == 0))
    counted = some.select(F.explode("s").alias("h")).groupBy("h").agg(F.count("*").alias("df")).where(F.col("df") >= COMMON_FROM)
    found = counted.orderBy(F.desc("df"), "h").limit(MOST_COMMON).toPandas().sort_values("h")
    return found["h"].to_numpy(np.int64), found["df"].to_numpy(np.int64)


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("ia").alias("id")).union(pairs.select("ib")).distinct()


def _scored(pairs: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """pairs of ids with the similarity of their sets s, and their keys where the sides have some."""
    renamed = lambda df, c: df.select(*[F.col(x).alias(x[0] + c) for x in ("id", "key", "s") if x in df.columns])
    joined = pairs.join(renamed(first, "a"), "ia").join(renamed(second, "b"), "ib")
    joined = joined.withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    score = F.col("shared").cast("double") / F.greatest(F.size("sa") + F.size("sb") - F.col("shared"), F.lit(1)).cast("double")
    return joined.withColumn("similarity", score).drop("sa", "sb", "shared")


def similar_pairs(texts: DataFrame, threshold: float, other: DataFrame | None = None) -> DataFrame:
    """a, b, similarity of all pairs with Jaccard similarity of threshold or more.

    texts: keyed(). Within texts a < b; with other (whose keys differ), a is from texts and b
    from other. In whatever order all shingles are put, pairs that can reach the threshold
    share some of their first shingles, their prefixes. The order is that of the hashes, those
    seen to be common last, which keeps them out of the join and changes no result. Where a
    pair meets it is counted how many it shares, and at which places the first and the last
    one stand. Nothing is shared before the first; after the last, and behind the prefix that
    ends first, stands all that can be shared besides. So a pair that shares too little is out
    before any list of shingles is moved. What is left, as a rule few, is verified on whole
    sets of hashes, then on the shingles themselves. Between stages only hashes are kept.
    """
    side = texts.withColumn("side", F.lit(0))
    both = side if other is None else side.unionByName(other.withColumn("side", F.lit(1)))
    rows = stored(_hashed(spread(both), threshold, _common(both)).select("id", "side", "n", F.posexplode("s").alias("i", "h")))
    last = 0 if other is None else 1
    a, b = rows.where("side = 0").drop("side").alias("a"), rows.where(F.col("side") == last).drop("side").alias("b")
    order = F.col("a.id") < F.col("b.id") if other is None else F.lit(True)
    na, nb = F.col("a.n"), F.col("b.n")
    fits = F.least(na, nb) >= threshold * F.greatest(na, nb) - _EPS
    # a shared shingle at places i and j has at most min(i, j) shared ones before it
    room = F.least(F.col("a.i"), F.col("b.i")) + F.least(na - F.col("a.i"), nb - F.col("b.i")) >= (na + nb) * (threshold / (1 + threshold)) - _EPS
    places = [f(f"{side}.i").alias(f"{name}_{side}") for name, f in (("first", F.min), ("last", F.max)) for side in ("a", "b")]
    met = a.join(b, F.col("a.h") == F.col("b.h")).where(order & fits & room).groupBy(F.col("a.id").alias("ia"), F.col("b.id").alias("ib")).agg(F.count("*").alias("shared"), F.max(na).alias("na"), F.max(nb).alias("nb"), *places)
    needed = F.ceil((F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - _EPS)
    behind = lambda n: F.ceil(n * threshold - _EPS) - 1
    after = F.least(F.col("na") - F.col("last_a") - 1, F.col("nb") - F.col("last_b") - 1, F.greatest(behind(F.col("na")), behind(F.col("nb"))))
    can = (F.least(F.col("na") - F.col("first_a"), F.col("nb") - F.col("first_b")) >= needed) & (F.col("shared") + after >= needed)
    close = stored(met.where(can).select("ia", "ib"))
    hashes = stored(_hashed(both.withColumn("id", F.xxhash64("key")).join(stored(_ids(close)), "id", "left_semi")))
    close = _scored(close, hashes.where("side = 0"), hashes.where(F.col("side") == last)).where(F.col("similarity") >= threshold - _EPS).select("ia", "ib")
    close = stored(close)
    sets = both.withColumn("id", F.xxhash64("key")).join(stored(_ids(close)), "id", "left_semi").select("id", "key", "side", T.shingles(T.tokens(F.col("text"))).alias("s"))
    found = _scored(close, sets.where("side = 0"), sets.where(F.col("side") == last)).where(F.col("similarity") >= threshold)
    if other is not None:
        return found.select(F.col("ka").alias("a"), F.col("kb").alias("b"), "similarity")
    swap = F.col("ka") > F.col("kb")
    return found.select(F.when(swap, F.col("kb")).otherwise(F.col("ka")).alias("a"), F.when(swap, F.col("ka")).otherwise(F.col("kb")).alias("b"), "similarity")


def greedy_removed(pairs: DataFrame) -> DataFrame:
    """Keys that go when documents are taken in the order of their keys.

    A key goes when an earlier neighbour stays. Keys are decided in rounds: removed once
    such a neighbour is known to stay, kept once all earlier ones are removed. Rounds end
    when none is undecided; their state is written to the shared folder each time.
    """
    edges = cut(pairs.select(F.col("a").alias("early"), F.col("b").alias("late")).distinct())
    nodes = edges.select(F.col("early").alias("key")).union(edges.select("late")).distinct()
    waiting = edges.select(F.col("late").alias("key")).distinct()
    state = cut(nodes.join(waiting.withColumn("open", F.lit(True)), "key", "left").select("key", F.when(F.col("open"), F.lit(None)).otherwise(F.lit(True)).cast("boolean").alias("kept")))
    while True:
        if state.where("kept is null").isEmpty():
            return state.where("not kept").select("key")
        early = edges.join(state.select(F.col("key").alias("early"), "kept"), "early")
        seen = early.groupBy(F.col("late").alias("key")).agg(F.max(F.coalesce("kept", F.lit(False))).alias("beaten"), F.min(F.when(F.col("kept") == F.lit(False), 1).otherwise(0)).alias("free"))
        step = F.when(F.col("beaten"), F.lit(False)).when(F.col("free") == 1, F.lit(True))
        state = cut(state.join(seen, "key", "left").select("key", F.coalesce("kept", step).alias("kept")))


def near_deduplicate(documents: DataFrame, key: str, threshold: float = THRESHOLD, content: str = "content") -> DataFrame:
    """documents without those similar to an earlier document that stays; key gives the order and is unique."""
    pairs = similar_pairs(keyed(documents, key, content), threshold)
    removed = sent_if_small(greedy_removed(pairs).select(F.col("key").alias(key)))
    return documents.join(removed, key, "left_anti")


def cross_deduplicate(organic: DataFrame, made: DataFrame, key: str, threshold: float = THRESHOLD, content: str = "content") -> DataFrame:
    """made with rejection_reason where a text repeats an organic one or an earlier made one that stays.

    Texts are compared by the hash of their normalised form and by shingles. Organic texts
    are not compared with one another.
    """
    reason = "duplicate_against_organic_or_branch"
    first, second = keyed(organic, key, content), keyed(made, key, content)
    plain = lambda df: df.select(F.col(key).alias("key"), T.content_hash(T.normalize(F.coalesce(F.col(content), F.lit("")))).alias("hash"))
    known, own = plain(organic), plain(made)
    against = own.join(known.select("hash").distinct(), "hash", "left_semi").select("key")
    against = cut(against.union(similar_pairs(first, threshold, second).select(F.col("b").alias("key"))).distinct())
    rest = second.join(against, "key", "left_anti")
    left = own.join(against, "key", "left_anti")
    equal = left.join(left.groupBy("hash").agg(F.min("key").alias("a")), "hash").where("a < key").select("a", F.col("key").alias("b"))
    inside = similar_pairs(rest, threshold).select("a", "b").union(equal)
    gone = against.union(greedy_removed(inside)).select(F.col("key").alias(key)).distinct().withColumn("_gone", F.lit(reason))
    return made.drop("rejection_reason").join(gone, key, "left").withColumnRenamed("_gone", "rejection_reason")
