"""Edges kept by partition key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.schemas import EDGES


def read_partitioned_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edges with their pkey; a filter on pkey prunes folders. The schema keeps keys like 10.10 from becoming numbers."""
    return spark.read.schema(f"{EDGES}, pkey string").parquet(path)


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """Ranked output with its rank: rows before the file, known from a count of each, and the row's place in it. Nothing is sorted.

    Of a work in several rows there is the first, which has its counts; such works, of which a file holds no other, are
    numbered in the order of their places.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
    in_parts = "part" in rows.columns
    if in_parts:
        rows = rows.where("part = 0").drop("part")
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # One row a file, so one task is enough.
    before = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    placed = rows.join(F.broadcast(before), "file")
    ranked = lambda some, nth: some.withColumn("rank", F.col("before") + nth).drop("file", "place", "before", "parts")
    if not in_parts:
        return ranked(placed, F.col("place") + 1)
    nth = F.row_number().over(Window.partitionBy("file").orderBy("place"))
    return ranked(placed.where("parts = 1"), F.col("place") + 1).unionByName(ranked(placed.where("parts > 1"), nth))
