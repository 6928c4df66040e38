"""Validation of cited identifiers against indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

def lookup(citations: DataFrame, source: str, index_a: DataFrame | None = None, index_b: DataFrame | None = None, column: str = "doi") -> DataFrame:
    """Adds matched_source: crossref, datacite or null. source: crossref probes A, datacite and arxiv probe B, all A then B.

    Both sides of the split come from this one left join; indexes are distinct, so no row multiplies.
    """
    out, known = citations, F.lit(None).cast("string")
    if source in ("all", "datacite", "arxiv") and index_b is not None:
        b = index_b.select(F.col("doi").alias("b_doi"))
        out, known = out.join(b, F.lower(out[column]) == F.col("b_doi"), "left"), F.when(F.col("b_doi").isNotNull(), "datacite")
    if source in ("all", "crossref") and index_a is not None:
        a = index_a.select(F.col("doi").alias("a_doi"))
        out, known = out.join(a, F.lower(out[column]) == F.col("a_doi"), "left"), F.when(F.col("a_doi").isNotNull(), "crossref").otherwise(known)
    return out.withColumn("matched_source", known).drop("a_doi", "b_doi")


def validation_stats(looked_up: DataFrame) -> DataFrame:
    return looked_up.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("matched_source") == "crossref").alias("crossref_matched"),
        F.count_if(F.col("matched_source") == "datacite").alias("datacite_matched"),
        F.count_if(F.col("matched_source").isNull()).alias("failed"),
    )


def split_by_provenance(citations: DataFrame, asserted: bool) -> DataFrame:
    """Keeps the citing entries of one kind, recounts, drops works left without any. reference_count stays."""
    opaque = isinstance(citations.schema["cited_by"].dataType.elementType, VariantType)
    found = lambda x: F.try_variant_get(x, "$.provenance", "string") if opaque else x.provenance
    is_asserted = lambda x: F.coalesce(found(x), F.lit("mined")).isin("publisher", "crossref")
    kept = F.filter("cited_by", lambda x: is_asserted(x) if asserted else ~is_asserted(x))
    out = citations.withColumn("cited_by", kept)
    return out.withColumn("citation_count", F.size("cited_by").cast("bigint")).where(F.col("citation_count") > 0)
