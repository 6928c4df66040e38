"""Counters of extraction and inversion, each one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.keys import partition_key


def extraction_stats(refs: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: references and items read, references with an edge, edges."""
    seen = refs.agg(F.count(F.lit(1)).alias("refs"), F.countDistinct("entry_ord", "item_ord").alias("items"))
    made = edges.agg(F.count(F.lit(1)).alias("matches"), F.countDistinct("entry_ord", "item_ord", "ref_index").alias("refs_with_matches"))
    both = seen.unionByName(made, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("refs", "items", "matches", "refs_with_matches")])


def inversion_stats(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count(F.lit(1)).alias("unique_works"), F.coalesce(F.sum("citation_count"), F.lit(0)).alias("citations"))


def partition_histogram(edges: DataFrame) -> DataFrame:
    return edges.groupBy(partition_key(F.col("cited_id")).alias("pkey")).agg(F.count(F.lit(1)).alias("n_edges"))
