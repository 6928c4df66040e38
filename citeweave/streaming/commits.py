"""Commit log of a run: what it has finished, by phase and key, as a table that only grows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run string, phase string, key string, n bigint, at timestamp"


def key_range(identifier: Column, ranges: int) -> Column:
    """The range of a cited identifier: a hash, as prefixes are of very different size."""
    return F.pmod(F.xxhash64(identifier), F.lit(ranges)).cast("int")


class CommitLog:
    """Rows of JSON below a folder. A commit is one file, so it is there as a whole or not at all.

    run is the digest of a run's input and options: commits of another one do not count.
    """

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path, run

    def rows(self) -> DataFrame:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.path).where(F.col("run") == self.run)

    def commit(self, phase: str, finished: DataFrame) -> None:
        """finished: key and n. What is written before a commit may be written again, what is committed is not."""
        rows = finished.select(F.lit(self.run).alias("run"), F.lit(phase).alias("phase"), F.col("key").cast("string").alias("key"), F.col("n").cast("bigint").alias("n"), F.current_timestamp().alias("at"))
        rows.coalesce(1).write.mode("append").json(self.path)

    def finished(self, phase: str) -> DataFrame:
        return self.rows().where(F.col("phase") == phase).select("key", "n").distinct()

    def pending(self, frame: DataFrame, key: Column, phase: str) -> DataFrame:
        """Rows whose key this run has not finished."""
        done = self.finished(phase).select(F.col("key").alias("done"))
        return frame.join(done, key.cast("string") == F.col("done"), "left_anti")
