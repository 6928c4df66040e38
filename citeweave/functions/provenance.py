"""How an identifier was obtained: asserted by the publisher, matched by the registry, or mined from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = ("mined", "crossref", "publisher")
ASSERTED = ("publisher", "crossref")


def provenance(doi_field: Column, asserted_by: Column, cited: Column) -> Column:
    """cited: the DOI that was found, or, of an arXiv id, the DOI made from it."""
    same = F.lower(doi_field) == F.lower(cited)
    return F.when(same & asserted_by.isin(*ASSERTED), asserted_by).otherwise(F.lit("mined"))


def rank(prov: Column) -> Column:
    return F.when(prov == "publisher", 2).when(prov == "crossref", 1).otherwise(0)


def from_rank(value: Column) -> Column:
    return F.when(value == 2, "publisher").when(value == 1, "crossref").otherwise("mined")
