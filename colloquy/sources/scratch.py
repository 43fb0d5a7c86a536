"""Folders for files that are written and read again within a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all machines share; a local one in one process where that is unset. Gone with the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.gettempdir()
    made = f"{base.rstrip('/')}/colloquy-{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(made)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return made


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to a folder and read again: what comes after does not work them out twice, and a lost executor costs a reread."""
    at = folder(rows.sparkSession, name)
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


#: Bytes of input for each core below which rows are dealt out anew.
SPREAD = 16 << 20


def spread(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a table at path, dealt out to all cores where it is so small that a few row groups hold it.

    A file of one row group is one task's work however many cores there are. A
    table of SPREAD bytes a core or more has row groups enough and stays as it is.
    """
    spark = rows.sparkSession
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = location.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(location).getLength()
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if size < SPREAD * cores else rows
