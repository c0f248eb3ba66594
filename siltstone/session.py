"""Session settings and the shared folder that long lineages are cut in."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, adaptive plans)."""
    builder = (
        SparkSession.builder.master(master)
        .appName("siltstone")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of checkpoints: the one the cluster names, else (tests) one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a shared folder there")
        named = tempfile.mkdtemp(prefix="siltstone-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The same rows read back from the shared folder: survives a lost executor, computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_TABLES: list[str] = []


def _remove_tables() -> None:
    """Takes the tables of stored() away at the end of the program, where the session still lives."""
    spark = SparkSession.getActiveSession()
    while spark is not None and _TABLES:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session is gone: nothing can be removed through it any more
            return


def stored(df: DataFrame) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, computed once.

    Unlike cut() its readers read only the columns they need, and Spark knows its size, so
    that a small one is broadcast and a large one is not.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _TABLES:
        atexit.register(_remove_tables)
    _TABLES.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of keys (a few numbers each) up to which a table is sent to all tasks.
SENT_ROWS = 200_000


def sent_if_small(keys: DataFrame) -> DataFrame:
    """A stored table of slim rows, to be broadcast where it holds SENT_ROWS or fewer (they are counted); else as it is."""
    return F.broadcast(keys) if keys.limit(SENT_ROWS + 1).count() <= SENT_ROWS else keys


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan over all cores where it has fewer partitions than cores; only a small input has so few."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan._jdf.queryExecution().toRdd().getNumPartitions() < cores else scan


def ensure_importable(spark: SparkSession) -> None:
    """Lets Python workers import this package: from its folder where they share the disk, else from an archive sent along."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if context.master.startswith("local"):
        known = context.environment.get("PYTHONPATH", "")
        if str(root) not in known.split(os.pathsep):
            context.environment["PYTHONPATH"] = os.pathsep.join(x for x in (str(root), known) if x)
    elif not getattr(context, "_siltstone_sent", False):
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "siltstone-package"), "zip", root, "siltstone")
        context.addPyFile(archive)
        context._siltstone_sent = True
