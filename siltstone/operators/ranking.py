"""Places within groups of any size, where a window would bring a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import cut, stored


def row_key(df: DataFrame) -> list[Column]:
    """Two hashes over all columns of a row but maps: equal only for rows that are equal there."""
    names = [c for c, kind in df.dtypes if "map<" not in kind]
    return [F.xxhash64(F.lit(seed), *names).alias(f"_k{seed}") for seed in (1, 2)]


def ranked(rows: DataFrame, by: list[Column], order: list[Column], name: str) -> DataFrame:
    """rows with their place from 1 within the group of by, in the order given; nulls form a group.

    Rows are range-partitioned by group and order, so a group that holds a third of all rows
    spreads over many tasks. Each partition numbers its own rows; how many rows of a group lie
    in earlier partitions is known from one count per partition and group, of which there are
    hardly more than partitions and groups. Give slim rows: all of them are moved and written.
    """
    keyed = rows.select("*", F.struct(*by).alias("_by"), F.struct(*order).alias("_o"))
    spread = keyed.repartitionByRange("_by", "_o").sortWithinPartitions("_by", "_o").drop("_o")
    numbered = cut(spread.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    counts = numbered.groupBy("_by", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_by").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored(counts.withColumn("_before", F.coalesce(before, F.lit(0))).select("_by", "_part", "_first", "_before"))
    placed = numbered.withColumn("_part", part).join(offsets, ["_by", "_part"])
    return placed.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first") + 1).drop("_by", "_part", "_at", "_first", "_before")
