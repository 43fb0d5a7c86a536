"""Calls of models that are paid for once: a ledger of answers by provider, model and prompt.

Before a pass, prompts that the ledger has are taken from it; the others, each
once, go to the model in tasks of a few calls, and every task puts its answers
into the ledger as it ends, whatever becomes of the job. So a rerun, and a
retry after a lost executor, calls again for the prompts of unfinished tasks
only: TASK of them at most for each.

Answers are matched by the SHA-256 of provider, model and prompt. Should two
runs call for one prompt at once, the ledger has both answers, and readers take
the smallest, each time the same.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prompts of a task.
TASK = 32
SCHEMA = "key string, said string"


class CallFailed(RuntimeError):
    """A model didn't answer within its budget of retries."""


def limited(call: Callable[[str], str], per_second: float | None = None, retries: int = 3, wait: float = 0.5, budget: int = 20) -> Callable[[Column, Column], Column]:
    """A generator (prompt, text) -> answer around a Python function of a prompt.

    A worker keeps to per_second calls a second, tries a call again up to
    `retries` times with growing pauses, and gives up for good once `budget`
    retries went in one batch of rows.
    """

    @F.pandas_udf("string")
    def ask(prompts: pd.Series) -> pd.Series:
        left, last, out = budget, 0.0, []
        for prompt in prompts:
            if prompt is None:
                out.append(None)
                continue
            for turn in range(retries + 1):
                if per_second:
                    time.sleep(max(0.0, last + 1 / per_second - time.monotonic()))
                last = time.monotonic()
                try:
                    out.append(call(prompt))
                    break
                except Exception as e:
                    left -= 1
                    if turn == retries or left < 0:
                        raise CallFailed(f"no answer after {turn + 1} calls: {e}") from e
                    time.sleep(wait * 2**turn)
        return pd.Series(out, dtype=object)

    return lambda prompt, text: ask(prompt)


class Ledger:
    """Answers under a path, as the tasks of all runs left them."""

    def __init__(self, spark: SparkSession, path: str, provider: str, model: str):
        self.spark, self.path, self.provider, self.model = spark, path.rstrip("/"), provider, model

    def _key(self, prompt: Column) -> Column:
        sized = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in (F.lit(self.provider), F.lit(self.model), prompt)]
        return F.sha2(F.concat(*sized), 256)

    def answers(self) -> DataFrame:
        """(key, said), one row a key."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path).groupBy("key").agg(F.min("said").alias("said"))

    def ask(self, rows: DataFrame, generate: Callable[[Column, Column], Column], prompt: str = "prompt", text: str = "chunk", into: str = "said") -> DataFrame:
        """rows with the answers to their prompts; new prompts are called for, and put down, at once."""
        keyed = rows.withColumn("_key", self._key(F.col(prompt)))
        new = keyed.filter(F.col(prompt).isNotNull()).join(self.answers(), F.col("_key") == F.col("key"), "left_anti")
        # Equal prompts are one call; the smallest text stands for its other texts.
        once = new.groupBy("_key").agg(F.min(F.struct(F.col(prompt).alias("p"), F.col(text).alias("t"))).alias("c"))
        n = once.count()
        if n:
            dealt = once.select("_key", "c.p", "c.t").repartition(-(-n // TASK))
            said = dealt.select(F.col("_key").alias("key"), generate(F.col("p"), F.col("t")).alias("said"))
            # With the second algorithm a task's file is in its place when the task ends, not when the job does.
            said.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").mode("append").parquet(self.path)
        return keyed.join(self.answers().withColumnRenamed("said", into), F.col("_key") == F.col("key"), "left").drop("_key", "key")
