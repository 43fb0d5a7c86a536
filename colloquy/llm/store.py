"""Intermediate tables in the shared folder that the cluster names.

Iterative operators cut their lineage by writing a table there and reading it
back, so a lost executor costs a reread instead of a recomputation.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch.
BATCH_BYTES = 8 << 20
_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one of our own where that is unset and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="colloquy-"))
        atexit.register(_remove_own)
    return _own[0]


def _remove_own() -> None:
    import shutil

    for folder in _own:
        shutil.rmtree(folder, ignore_errors=True)


def bound_batches(spark: SparkSession) -> None:
    """Cut the session's Arrow batches by bytes as well as rows, so very long texts don't pile up in one batch.

    The setting has to outlive this call, as results are worked out when they
    are asked for; a lower one of the caller's stays.
    """
    held = spark.conf.get(_BATCH_BYTES)
    held = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held))
    if not 0 < held <= BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


class Store:
    """Tables of one run of an operator, under a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        # Gone when the application ends, if nothing frees the tables before.
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        bound_batches(spark)

    def save(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        """Write df as Parquet and return the reread table; its shuffle files go at once."""
        self._n += 1
        path = f"{self.root}/t{self._n}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path, compression=compression)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._store_path = path
        return table

    def free(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._store_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
