"""Small files on whatever file system a path names: local, HDFS or an object store, through Hadoop."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _at(spark, path)
    return system.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    system, at = _at(spark, path)
    system.mkdirs(at)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """A file of UTF-8 text; without overwrite it must not exist."""
    system, at = _at(spark, path)
    if not overwrite and system.exists(at):
        raise FileExistsError(path)
    out = system.create(at, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
