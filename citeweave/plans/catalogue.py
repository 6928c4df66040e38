"""Queries over the derived reference corpus, one per operator, with the SQL that gives the same rows elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave import fixtures
from citeweave.functions.arxiv import arxiv_doi, normalize_arxiv
from citeweave.functions.doi import doi_prefix, normalize_doi
from citeweave.functions.keys import partition_key
from citeweave.functions.provenance import rank
from citeweave.operators import index as ix
from citeweave.operators.extract import extract_edges, search_text
from citeweave.operators.invert import best_provenance, citation_counts, dedup_edges, invert, split_counts
from citeweave.operators.stats import extraction_stats, inversion_stats, partition_histogram
from citeweave.operators.validate import lookup, validation_stats
from citeweave.plans import stored


def _edges(spark: SparkSession, d: str, mode: str = "doi") -> DataFrame:
    return extract_edges(fixtures.references(spark, d), mode)


def _paired(spark: SparkSession, d: str, mode: str = "doi") -> DataFrame:
    return fixtures.by_pair(spark, d, _edges(spark, d, mode))


def _inverted(spark, d, mode="doi"):
    inv = invert(_paired(spark, d, mode), mode)
    raws = F.transform("cited_by", lambda c: F.concat_ws("|", c.doi, c.provenance, c.matches[0].raw_match))
    out = inv.withColumn("cited_by", F.array_join(F.array_sort(raws), ";"))
    return out


def _counts(spark, d):
    return citation_counts(_edges(spark, d))


def _lookup(spark, d, source):
    return lookup(_counts(spark, d), source, fixtures.index_a(spark, d), fixtures.index_b(spark, d), "cited_id")


def _split(spark, d, asserted):
    return split_counts(_paired(spark, d), asserted)


def _refs(spark, d):
    return fixtures.references(spark, d).withColumn("text", search_text())


KEY = ("citing_doi", "item_ord", "ref_index")


def queries() -> dict:
    idx = {"a": fixtures.index_a, "b": fixtures.index_b}
    return stored.queries() | {
        "search_text": lambda s, d: _refs(s, d).select(*KEY, "text"),
        "doi_extract": lambda s, d: _edges(s, d).select(*KEY, "match_ord", "raw_match", "cited_id"),
        "doi_normalize": lambda s, d: _refs(s, d).select(*KEY, normalize_doi(F.col("text")).alias("normal")),
        "doi_prefix": lambda s, d: _edges(s, d).select("cited_id", doi_prefix(F.col("cited_id")).alias("prefix")).distinct(),
        "partition_key": lambda s, d: _edges(s, d).unionByName(_edges(s, d, "arxiv")).select("cited_id", partition_key(F.col("cited_id")).alias("pkey")).distinct(),
        "arxiv_extract": lambda s, d: _edges(s, d, "arxiv").select(*KEY, "raw_match", "cited_id"),
        "arxiv_normalize": lambda s, d: _refs(s, d).select(*KEY, normalize_arxiv(F.concat("text", F.lit("v3"))).alias("normal")),
        "arxiv_doi": lambda s, d: _edges(s, d, "arxiv").select("cited_id", arxiv_doi(F.col("cited_id")).alias("arxiv_doi")).distinct(),
        "provenance": lambda s, d: _edges(s, d).groupBy("provenance", rank(F.col("provenance")).alias("level")).agg(F.count(F.lit(1)).alias("n_edges")),
        "edges": lambda s, d: _edges(s, d).select(*KEY, "match_ord", "raw_match", "cited_id", "provenance"),
        "self_citation_filter": lambda s, d: _edges(s, d).groupBy("citing_doi").agg(F.count(F.lit(1)).alias("n_edges")),
        "edge_dedup_first": lambda s, d: dedup_edges(_paired(s, d)).select("citing_doi", "cited_id", "raw_match", "provenance", "ref_index"),
        "edge_dedup_best": lambda s, d: dedup_edges(_paired(s, d), "best").select("citing_doi", "cited_id", "provenance"),
        "invert_generic": lambda s, d: _inverted(s, d),
        "invert_arxiv": lambda s, d: _inverted(s, d, "arxiv"),
        "best_provenance": lambda s, d: best_provenance(_paired(s, d)),
        "index_build": lambda s, d: ix.build_index(fixtures.references(s, d), "citing_doi"),
        "index_prefixes": lambda s, d: ix.index_prefixes(ix.merge_indexes(*[f(s, d) for f in idx.values()])),
        "index_merge": lambda s, d: ix.merge_indexes(*[f(s, d) for f in idx.values()]),
        "index_stats": lambda s, d: ix.index_stats(ix.merge_indexes(*[f(s, d) for f in idx.values()])),
        "validate_crossref": lambda s, d: _lookup(s, d, "crossref").where("matched_source IS NOT NULL").select("cited_id", "citation_count", "reference_count"),
        "validate_datacite": lambda s, d: _lookup(s, d, "datacite").where("matched_source IS NOT NULL").select("cited_id", "citation_count", "reference_count"),
        "validate_failed": lambda s, d: _lookup(s, d, "crossref").where("matched_source IS NULL").select("cited_id", "citation_count"),
        "validate_all": lambda s, d: _lookup(s, d, "all").select("cited_id", "citation_count", "matched_source"),
        "prefix_known": lambda s, d: ix.with_known_prefix(_counts(s, d), fixtures.index_b(s, d)).select("cited_id"),
        "prefix_source": lambda s, d: ix.prefix_source(_counts(s, d), fixtures.index_a(s, d), fixtures.index_b(s, d)).select("cited_id", "prefix_source"),
        "split_asserted": lambda s, d: _split(s, d, True),
        "split_mined": lambda s, d: _split(s, d, False),
        "partition_histogram": lambda s, d: partition_histogram(_edges(s, d)),
        "extraction_stats": lambda s, d: extraction_stats(fixtures.references(s, d), _edges(s, d)),
        "invert_stats": lambda s, d: inversion_stats(_counts(s, d)),
        "validate_stats": lambda s, d: validation_stats(_lookup(s, d, "all")),
        "ranked_citations": lambda s, d: _counts(s, d).orderBy(F.desc("citation_count"), F.asc("cited_id")),
    }


def _normal(x: str) -> str:
    for escape, plain in (("%2F", "/"), ("%2f", "/"), ("%3A", ":"), ("%3a", ":"), ("%28", "("), ("%29", ")"), ("%3C", "<"), ("%3c", "<"), ("%3E", ">"), ("%3e", ">")):
        x = f"replace({x}, '{escape}', '{plain}')"
    return f"""lower(regexp_replace(rtrim({x}, '.,;:)]>"'' '), '(?:&quot)?(?:&amp)?(?:&lt)?(?:&gt)?$', ''))"""


DOI = r"""(?i)(?:doi[:\s]*|(?:https?://)?(?:dx\.)?doi\.org/)?(10\.\d{4,}/[^\s\]\)>,;"'']+)"""
ARXIV = (
    r"(?i)(arxiv[.:\s]+(\d{4}\.\d{4,6}(?:v\d+)?))",
    r"(?i)(arxiv[.:\s]+([a-z][a-z0-9.-]*/\s*\d{7}(?:v\d+)?))",
    r"(?i)(10\.48550/arxiv\.(\d{4}\.\d{4,6}(?:v\d+)?))",
    r"(?i)(arxiv\.org/(?:abs|pdf)/(\d{4}\.\d{4,6}(?:v\d+)?|[a-z][a-z0-9.-]*/\d{7}(?:v\d+)?))",
)


def _arxiv_normal(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({x}), '\s', '', 'g'), '^([^v]*)v[0-9]+$', '\1')"


def _with() -> str:
    arxiv = " UNION ALL ".join(
        f"SELECT *, {k} AS form, unnest(regexp_extract_all(text, '{p}', 1)) AS raw, unnest(regexp_extract_all(text, '{p}', 2)) AS x, generate_subscripts(regexp_extract_all(text, '{p}', 1), 1) AS o FROM rt"
        for k, p in enumerate(ARXIV)
    )
    # A DOI is compared as it was found, an arXiv id as the DOI that is made from it; case does not matter.
    proven, proven_arxiv = (
        f"CASE WHEN lower(doi_field) = lower({found}) AND asserted_by IN ('publisher', 'crossref') THEN asserted_by ELSE 'mined' END" for found in ("id", "concat('10.48550/arXiv.', id)")
    )
    return f"""WITH {fixtures.duckdb_corpus()},
rt AS (SELECT *, concat_ws(' ', doi_field, url, article_title, journal_title, unstructured) AS text FROM refs),
d0 AS (SELECT *, unnest(regexp_extract_all(text, '{DOI}', 1)) AS raw, generate_subscripts(regexp_extract_all(text, '{DOI}', 1), 1) AS o FROM rt),
d1 AS (SELECT *, {_normal("raw")} AS id FROM d0),
d2 AS (SELECT *, row_number() OVER (PARTITION BY item_ord, ref_index, id ORDER BY o) AS nth FROM d1),
d3 AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_ord, ref_index ORDER BY o) - 1 AS BIGINT) AS match_ord FROM d2 WHERE nth = 1),
e AS (SELECT citing_doi, item_ord, ref_index, match_ord, raw AS raw_match, id AS cited_id, {proven} AS provenance FROM d3 WHERE lower(citing_doi) <> id),
a0 AS ({arxiv}),
a1 AS (SELECT *, {_arxiv_normal("x")} AS id FROM a0),
a2 AS (SELECT *, row_number() OVER (PARTITION BY item_ord, ref_index, id ORDER BY form, o) AS nth FROM a1),
ea AS (SELECT citing_doi, item_ord, ref_index, CAST(row_number() OVER (PARTITION BY item_ord, ref_index ORDER BY form, o) - 1 AS BIGINT) AS match_ord, raw AS raw_match, id AS cited_id, {proven_arxiv} AS provenance FROM a2 WHERE nth = 1 AND lower(citing_doi) <> id),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY citing_doi, cited_id ORDER BY item_ord, ref_index, match_ord) AS nth FROM e) WHERE nth = 1),
ua AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY citing_doi, cited_id ORDER BY item_ord, ref_index, match_ord) AS nth FROM ea) WHERE nth = 1),
ub AS (SELECT citing_doi, cited_id, max(CASE provenance WHEN 'publisher' THEN 2 WHEN 'crossref' THEN 1 ELSE 0 END) AS r FROM e GROUP BY ALL),
ubp AS (SELECT citing_doi, cited_id, CASE r WHEN 2 THEN 'publisher' WHEN 1 THEN 'crossref' ELSE 'mined' END AS provenance FROM ub),
c AS (SELECT cited_id, count(*) AS citation_count, count(*) AS reference_count FROM u WHERE citing_doi <> cited_id GROUP BY 1),
cs AS (SELECT c.*, CASE WHEN a.doi IS NOT NULL THEN 'crossref' WHEN b.doi IS NOT NULL THEN 'datacite' END AS matched_source FROM c LEFT JOIN idx_a a ON a.doi = cited_id LEFT JOIN idx_b b ON b.doi = cited_id),
m AS (SELECT * FROM idx_a UNION SELECT * FROM idx_b)
"""


def oracle_sql() -> dict[str, str]:
    prefix = "CASE WHEN {0} LIKE '10.%/%' THEN lower(split_part({0}, '/', 1)) END"
    pkey = "CASE WHEN cited_id LIKE '10.%/%' THEN lower(split_part(cited_id, '/', 1)) ELSE replace(substr(lower(cited_id), 1, 4), '/', '_') END"
    gathered = "string_agg(concat_ws('|', citing_doi, provenance, raw_match), ';' ORDER BY encode(concat_ws('|', citing_doi, provenance, raw_match)))"
    pa, pb = (f"SELECT DISTINCT {prefix.format('doi')} AS p FROM idx_{x}" for x in "ab")
    selects = {
        "search_text": "SELECT citing_doi, item_ord, ref_index, text FROM rt",
        "doi_extract": "SELECT citing_doi, item_ord, ref_index, match_ord, raw_match, cited_id FROM e",
        "doi_normalize": f"SELECT citing_doi, item_ord, ref_index, {_normal('text')} AS normal FROM rt",
        "doi_prefix": f"SELECT DISTINCT cited_id, {prefix.format('cited_id')} AS prefix FROM e",
        "partition_key": f"SELECT DISTINCT cited_id, {pkey} AS pkey FROM (SELECT cited_id FROM e UNION ALL SELECT cited_id FROM ea)",
        "arxiv_extract": "SELECT citing_doi, item_ord, ref_index, raw_match, cited_id FROM ea",
        "arxiv_normalize": f"SELECT citing_doi, item_ord, ref_index, {_arxiv_normal("concat(text, 'v3')")} AS normal FROM rt",
        "arxiv_doi": "SELECT DISTINCT cited_id, concat('10.48550/arXiv.', cited_id) AS arxiv_doi FROM ea",
        "provenance": "SELECT provenance, CASE provenance WHEN 'publisher' THEN 2 WHEN 'crossref' THEN 1 ELSE 0 END AS level, count(*) AS n_edges FROM e GROUP BY ALL",
        "edges": "SELECT * FROM e",
        "self_citation_filter": "SELECT citing_doi, count(*) AS n_edges FROM e GROUP BY 1",
        "edge_dedup_first": "SELECT citing_doi, cited_id, raw_match, provenance, ref_index FROM u",
        "edge_dedup_best": "SELECT * FROM ubp",
        "invert_generic": f"SELECT cited_id, count(*) AS citation_count, count(*) AS reference_count, {gathered} AS cited_by FROM u WHERE citing_doi <> cited_id GROUP BY 1",
        "invert_arxiv": f"SELECT cited_id, count(*) AS citation_count, count(*) AS reference_count, {gathered} AS cited_by, concat('10.48550/arXiv.', cited_id) AS arxiv_doi FROM ua WHERE citing_doi <> cited_id GROUP BY cited_id",
        "best_provenance": "SELECT * FROM ubp",
        "index_build": "SELECT DISTINCT lower(citing_doi) AS doi FROM refs",
        "index_prefixes": f"SELECT DISTINCT {prefix.format('doi')} AS prefix FROM m WHERE doi LIKE '10.%/%'",
        "index_merge": "SELECT doi FROM m",
        "index_stats": f"SELECT count(*) AS dois, count(DISTINCT {prefix.format('doi')}) AS prefixes FROM m",
        "validate_crossref": "SELECT * FROM c WHERE cited_id IN (SELECT doi FROM idx_a)",
        "validate_datacite": "SELECT * FROM c WHERE cited_id IN (SELECT doi FROM idx_b)",
        "validate_failed": "SELECT cited_id, citation_count FROM c WHERE cited_id NOT IN (SELECT doi FROM idx_a)",
        "validate_all": "SELECT cited_id, citation_count, matched_source FROM cs",
        "prefix_known": f"SELECT cited_id FROM c WHERE {prefix.format('cited_id')} IN ({pb})",
        "prefix_source": f"SELECT cited_id, CASE WHEN a.p IS NOT NULL AND b.p IS NOT NULL THEN 'both' WHEN a.p IS NOT NULL THEN 'crossref' WHEN b.p IS NOT NULL THEN 'datacite' ELSE 'none' END AS prefix_source FROM c LEFT JOIN ({pa}) a ON a.p = {prefix.format('cited_id')} LEFT JOIN ({pb}) b ON b.p = {prefix.format('cited_id')}",
        "split_asserted": "SELECT c.cited_id, count(*) AS citation_count, any_value(reference_count) AS reference_count FROM c JOIN u ON u.cited_id = c.cited_id AND citing_doi <> u.cited_id WHERE provenance <> 'mined' GROUP BY 1",
        "split_mined": "SELECT c.cited_id, count(*) AS citation_count, any_value(reference_count) AS reference_count FROM c JOIN u ON u.cited_id = c.cited_id AND citing_doi <> u.cited_id WHERE provenance = 'mined' GROUP BY 1",
        "partition_histogram": f"SELECT {pkey} AS pkey, count(*) AS n_edges FROM e GROUP BY 1",
        "extraction_stats": "SELECT (SELECT count(*) FROM refs) AS refs, (SELECT count(DISTINCT item_ord) FROM refs) AS items, (SELECT count(*) FROM e) AS matches, (SELECT count(*) FROM (SELECT DISTINCT item_ord, ref_index FROM e)) AS refs_with_matches",
        "invert_stats": "SELECT count(*) AS unique_works, CAST(sum(citation_count) AS BIGINT) AS citations FROM c",
        "validate_stats": "SELECT count(*) AS total, count(*) FILTER (WHERE matched_source = 'crossref') AS crossref_matched, count(*) FILTER (WHERE matched_source = 'datacite') AS datacite_matched, count(*) FILTER (WHERE matched_source IS NULL) AS failed FROM cs",
        "ranked_citations": "SELECT * FROM c ORDER BY citation_count DESC, cited_id",
    }
    return {k: _with() + v for k, v in (selects | stored.oracle_selects(pkey, prefix)).items()}
