"""Intermediate tables in the folder that all executors share, and the settings the operators rely on."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.staging import shared_folder, write_once

#: Bytes and rows of one Arrow batch at most: bounds the memory of a Python worker whatever the length of texts.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4000


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python by bytes too; a batch of long texts then has few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


class Scratch:
    """Parquet tables of one operator run; ``close`` drops those that no returned frame reads."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        atexit.register(self.close)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it from there: lineage is cut, and a lost executor costs no recomputation."""
        path = f"{self.base}/{name}-{len(self.paths)}"
        self.paths[path] = name
        write_once(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names."""
        for path in [p for p, n in self.paths.items() if n in names]:
            del self.paths[path]
            self._delete(path)

    def close(self) -> None:
        """Delete everything, at the end of the session."""
        if self.paths and self.spark.sparkContext._jsc is not None:
            self.paths.clear()
            self._delete(self.base)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
