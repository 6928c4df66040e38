"""References to edges: text assembly, identifier extraction, provenance, self-citation filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from citeweave.functions.arxiv import arxiv_doi, arxiv_matches
from citeweave.functions.doi import doi_matches
from citeweave.functions.provenance import provenance

TEXT_FIELDS = ("doi_field", "url", "article_title", "journal_title", "unstructured")


def search_text() -> Column:
    """Present text fields joined by a blank; matches may span fields."""
    return F.concat_ws(" ", *TEXT_FIELDS)


def explode_references(works: DataFrame) -> DataFrame:
    """One row per reference of every work that has a DOI, with its position."""
    return (
        works.where(F.col("doi").isNotNull())
        .select(F.lower("doi").alias("citing_doi"), "entry_ord", "item_ord", F.posexplode("refs").alias("ref_index", "r"))
        .select("citing_doi", "entry_ord", "item_ord", F.col("ref_index").cast("bigint"), "r.*")
    )


def extract_edges(refs: DataFrame, mode: str = "doi", compare_arxiv_doi: bool = False, counters: Observation | None = None) -> DataFrame:
    """Edges citing -> cited. mode: doi or arxiv. Narrow: no shuffle.

    A work citing itself is dropped. In arxiv mode ids are compared as they are, so nothing is dropped
    unless compare_arxiv_doi also compares the DOI built from the id. counters gets matches and refs_with_matches of
    whatever job writes the edges.
    """
    matches = doi_matches if mode == "doi" else arxiv_matches
    citing, cited = F.lower("citing_doi"), F.col("m.id")
    compared = [lambda x: F.lower(x), *([lambda x: F.lower(arxiv_doi(x))] if mode == "arxiv" and compare_arxiv_doi else [])]
    found = refs.withColumn("text", search_text()).where(F.col("text") != "")
    if counters is None:
        edges = found.select("*", F.posexplode(matches(F.col("text"))).alias("match_ord", "m"))
    else:
        others = found.withColumn("ms", matches(F.col("text"))).withColumn("first", F.array_position(F.transform("ms", lambda m: _all(citing != f(m.id) for f in compared)), F.lit(True)) - 1)
        edges = others.select("*", F.posexplode("ms").alias("match_ord", "m"))
    for f in compared:
        edges = edges.where(citing != f(cited))
    if counters is not None:
        # One edge of every reference that has any is its first.
        edges = edges.observe(counters, F.count(F.lit(1)).alias("matches"), F.count_if(F.col("match_ord") == F.col("first")).alias("refs_with_matches"))
    return edges.select(
        "citing_doi",
        "entry_ord",
        F.col("item_ord").cast("bigint").alias("item_ord"),
        "ref_index",
        F.col("match_ord").cast("bigint").alias("match_ord"),
        "ref_json",
        F.col("m.raw").alias("raw_match"),
        cited.alias("cited_id"),
        provenance(F.col("doi_field"), F.col("asserted_by"), cited if mode == "doi" else arxiv_doi(cited)).alias("provenance"),
    )


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
