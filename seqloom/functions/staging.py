"""Cutting lineage of multi-pass operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_staged: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder, so later passes read it instead of recomputing."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed Parquet table to the shared folder and read it from there; deleted at the end of the session.

    For wide rows of which later passes read few columns: a checkpoint holds them unpacked and is read whole.
    A table that is staged already is returned as it is.
    """
    if df in _staged:
        return df
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/seqloom-{uuid.uuid4().hex}"
    write_once(df, path)
    atexit.register(_delete, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _staged[out] = path
    return out


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df`` as compressed Parquet; its shuffles have served then, and would else stay until the driver happens to collect garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEANUP, before)


def discard(staged: DataFrame) -> None:
    """Delete a table of ``stage_table`` that no later pass reads."""
    _delete(staged.sparkSession, _staged.pop(staged))


def _delete(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a local master where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="seqloom-checkpoint-")


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add ``columns`` through a one-row generator.

    Filters on a projected column are pushed below the projection with its expression copied, and so are
    evaluated again; nothing is pushed or copied through a generator. For costly array folds and Python functions only.
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(packed))
