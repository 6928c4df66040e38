"""Identifier indexes: one-column DataFrames with set semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.doi import doi_prefix


def build_index(frame: DataFrame, doi: str | Column = "doi") -> DataFrame:
    column = F.col(doi) if isinstance(doi, str) else doi
    return frame.select(F.lower(column).alias("doi")).where(F.col("doi").isNotNull()).distinct()


def index_prefixes(index: DataFrame) -> DataFrame:
    return index.select(doi_prefix(F.col("doi")).alias("prefix")).where(F.col("prefix").isNotNull()).distinct()


def merge_indexes(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def index_stats(index: DataFrame) -> DataFrame:
    return index.agg(F.count("doi").alias("dois"), F.countDistinct(doi_prefix(F.col("doi"))).alias("prefixes"))


def with_known_prefix(frame: DataFrame, index: DataFrame, column: str = "cited_id") -> DataFrame:
    """Rows with an identifier under a prefix that the index knows."""
    prefixes = index_prefixes(index)
    return frame.join(prefixes, doi_prefix(frame[column]) == prefixes.prefix, "left_semi")


def prefix_source(frame: DataFrame, a: DataFrame, b: DataFrame, column: str = "cited_id") -> DataFrame:
    """Adds prefix_source: none, crossref, datacite or both, by whose index knows the prefix."""
    in_a, in_b = (index_prefixes(x).withColumn("side", F.lit(side)) for x, side in ((a, "crossref"), (b, "datacite")))
    # One small table of prefixes, so that frame meets one join, broadcast while that table is small.
    sides = in_a.unionByName(in_b).groupBy(F.col("prefix").alias("p")).agg(F.when(F.count(F.lit(1)) > 1, "both").otherwise(F.min("side")).alias("prefix_source"))
    keyed = frame.withColumn("p", doi_prefix(F.col(column)))
    return keyed.join(sides, "p", "left").withColumn("prefix_source", F.coalesce("prefix_source", F.lit("none"))).drop("p")
