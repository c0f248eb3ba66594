"""The stateless operators over a stream: files that arrive are screened as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltstone.functions.signals import Parser
from siltstone.operators.filters import quality_filter


def watch(spark: SparkSession, folder: str, schema: str | StructType, per_trigger: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream of documents."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def screen_stream(documents: DataFrame, output: str, checkpoint: str, parser: Parser | None = None) -> StreamingQuery:
    """Writes every document with its verdict; each file is processed once, also after a restart."""
    screened = quality_filter(documents, parser)
    return screened.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
