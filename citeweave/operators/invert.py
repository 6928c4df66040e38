"""Edge deduplication and inversion by cited identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.arxiv import arxiv_doi
from citeweave.functions.provenance import rank

ORDER = ("entry_ord", "item_ord", "ref_index", "match_ord")


def dedup_edges(edges: DataFrame, keep: str = "first", within: tuple[str, ...] = ()) -> DataFrame:
    """One edge per (citing, cited): the first in input order, or the one of best provenance.

    An aggregate with map-side combine; no sort and no window. Repeats of a hot pair shrink before the shuffle.
    within: columns that follow from the pair and are kept; edges dealt out by them are not shuffled again.
    """
    first = F.struct(*ORDER)
    by = first if keep == "first" else F.struct((-rank(F.col("provenance"))).alias("r"), *ORDER)
    best = F.min_by(F.struct("raw_match", "ref_json", "provenance", *ORDER), by)
    return edges.groupBy(*within, "citing_doi", "cited_id").agg(best.alias("b")).select("citing_doi", "cited_id", "b.*", *within)


def citation_counts(edges: DataFrame) -> DataFrame:
    """Counts only: distinct pairs are shuffled without what else an edge has, and no list is gathered."""
    return (
        edges.where(F.col("citing_doi") != F.col("cited_id"))
        .select("citing_doi", "cited_id")
        .distinct()
        .groupBy("cited_id")
        .agg(F.count("citing_doi").alias("citation_count"), F.count("citing_doi").alias("reference_count"))
    )


def dedup_links(edges: DataFrame, keep: str = "first", within: tuple[str, ...] = ()) -> DataFrame:
    """What is inverted: one edge per pair, without works that cite themselves in the same spelling."""
    return dedup_edges(edges, keep, within).where(F.col("citing_doi") != F.col("cited_id"))


def entry_of_link() -> Column:
    """What cited_by has of a citing work."""
    match = F.struct("raw_match", F.col("ref_json").alias("reference"), "provenance")
    return F.struct(F.col("citing_doi").alias("doi"), F.col("provenance"), F.array(match).alias("matches"))


def invert(edges: DataFrame, mode: str = "doi", keep: str = "first") -> DataFrame:
    """One row per cited identifier with its citing works, sorted by DOI inside the row."""
    out = (
        dedup_links(edges, keep)
        .groupBy("cited_id")
        .agg(
            F.count("citing_doi").alias("citation_count"),
            F.count("citing_doi").alias("reference_count"),
            F.array_sort(F.collect_list(entry_of_link())).alias("cited_by"),
        )
    )
    return out.withColumn("arxiv_doi", arxiv_doi(F.col("cited_id"))) if mode == "arxiv" else out


def split_counts(edges: DataFrame, asserted: bool, keep: str = "first") -> DataFrame:
    """Citing works of one kind a cited identifier, beside all of them; works without any go. No list is gathered."""
    is_asserted = F.coalesce("provenance", F.lit("mined")).isin("publisher", "crossref")
    return (
        dedup_links(edges, keep)
        .groupBy("cited_id")
        .agg(F.count_if(is_asserted if asserted else ~is_asserted).alias("citation_count"), F.count("citing_doi").alias("reference_count"))
        .where("citation_count > 0")
    )


def link_counts(links: DataFrame) -> DataFrame:
    """Counts of deduplicated links by cited identifier; no list is gathered."""
    return links.groupBy("cited_id").agg(F.count(F.lit(1)).alias("citation_count"), F.count(F.lit(1)).alias("reference_count"))


def ranked(inverted: DataFrame) -> DataFrame:
    return inverted.orderBy(F.desc("citation_count"), F.asc("cited_id"))


def best_provenance(edges: DataFrame) -> DataFrame:
    """Highest provenance over all edges of a (citing, cited) pair."""
    return edges.groupBy("citing_doi", "cited_id").agg(F.max_by("provenance", rank(F.col("provenance"))).alias("provenance"))
