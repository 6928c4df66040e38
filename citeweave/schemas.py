"""Declared schemas of inputs, intermediates and outputs; nothing is inferred from production JSON."""

REFERENCE = (
    "struct<doi_field string, url string, article_title string, journal_title string,"
    " unstructured string, asserted_by string, ref_json string>"
)
WORKS = f"entry_path string, entry_ord bigint, item_ord int, doi string, refs array<{REFERENCE}>"
#: Items, and rows of members, which have a status instead of an item_ord.
SCAN = f"{WORKS}, status string"
REFS = (
    "citing_doi string, entry_ord bigint, item_ord bigint, ref_index bigint, doi_field string, url string,"
    " article_title string, journal_title string, unstructured string, asserted_by string, ref_json string"
)
EDGES = (
    "citing_doi string, entry_ord bigint, item_ord bigint, ref_index bigint, match_ord bigint,"
    " ref_json string, raw_match string, cited_id string, provenance string"
)
#: Edges, one a pair.
LINKS = (
    "citing_doi string, cited_id string, raw_match string, ref_json string, provenance string,"
    " entry_ord bigint, item_ord bigint, ref_index bigint, match_ord bigint"
)
CITED_BY = (
    "array<struct<doi string, provenance string,"
    " matches array<struct<raw_match string, reference string, provenance string>>>>"
)
INVERTED = f"cited_id string, citation_count bigint, reference_count bigint, cited_by {CITED_BY}"
