"""Batch-wise Python stages over Arrow, for operators no built-in expression can state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from siltstone import batches


#: Nodes of a logical plan that only read, choose and compute columns of rows where they are.
_READS = {"LogicalRelation", "Relation", "DataSourceV2Relation", "DataSourceV2ScanRelation", "LogicalRDD", "LocalRelation", "Project", "Filter", "SubqueryAlias", "Range"}


def _nodes(plan) -> Iterator[str]:
    """Names of the nodes of a logical plan."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node.nodeName().split(" ")[0]
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where it is a plain scan with fewer partitions than cores; else df as it is.

    Only a small input is read in so few partitions, so only a small input is moved.
    """
    execution = df._jdf.queryExecution()
    if not _READS.issuperset(_nodes(execution.optimizedPlan())):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if execution.toRdd().getNumPartitions() < cores else df


def map_rows(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[..., list]]) -> DataFrame:
    """batches.map_rows() over all cores."""
    return batches.map_rows(spread(df.select(*columns)), columns, schema, make)
