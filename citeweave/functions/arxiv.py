"""arXiv identifier extraction and normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.functions.doi import keep_first

# The four identifier forms, in the order in which they are tried (group 1 raw, group 2 id).
ARXIV_PATTERNS = (
    r"(?iU)(arxiv[.:\s]+(\d{4}\.\d{4,6}(?:v\d+)?))",
    r"(?iU)(arxiv[.:\s]+([a-z][a-z0-9.-]*/\s*\d{7}(?:v\d+)?))",
    r"(?iU)(10\.48550/arxiv\.(\d{4}\.\d{4,6}(?:v\d+)?))",
    r"(?iU)(arxiv\.org/(?:abs|pdf)/(\d{4}\.\d{4,6}(?:v\d+)?|[a-z][a-z0-9.-]*/\d{7}(?:v\d+)?))",
)
ARXIV_DOI_PREFIX = "10.48550/arXiv."


def normalize_arxiv(arxiv_id: Column) -> Column:
    """Lower case, no white space, version dropped when the first v of the id starts it."""
    compact = F.regexp_replace(F.lower(arxiv_id), r"(?U)\s", "")
    return F.regexp_replace(compact, r"^([^v]*)v[0-9]+\z", "$1")


def arxiv_doi(arxiv_id: Column) -> Column:
    return F.concat(F.lit(ARXIV_DOI_PREFIX), arxiv_id)


def arxiv_id_of_doi(doi: Column) -> Column:
    return F.regexp_replace(doi, r"^10\.48550/ar[Xx]iv\.", "")


def arxiv_matches(text: Column) -> Column:
    """array<struct<raw, id>>; the forms are tried in order and the first match of an id stays."""
    found = [
        F.zip_with(
            F.regexp_extract_all(text, F.lit(p), F.lit(1)),
            F.regexp_extract_all(text, F.lit(p), F.lit(2)),
            lambda raw, x: F.struct(raw.alias("raw"), normalize_arxiv(x).alias("id")),
        )
        for p in ARXIV_PATTERNS
    ]
    return keep_first(F.concat(*found))
