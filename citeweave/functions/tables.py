"""extract_identifiers(text, mode): a SQL table function for lateral joins. It is plain SQL, which Spark inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from citeweave.functions.arxiv import ARXIV_PATTERNS
from citeweave.functions.doi import DOI_PATTERN, ENTITY_TAIL, ESCAPES, TRAILING

#: A row a match: its place, as it stands in the text, and normalised.
COLUMNS = "match_ord BIGINT, raw_match STRING, identifier STRING"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _normal_doi(doi: str) -> str:
    for escape, plain in ESCAPES.items():
        doi = f"regexp_replace({doi}, {_quoted(escape)}, {_quoted(plain)})"
    return f"lower(regexp_replace(trim(TRAILING {_quoted(TRAILING)} FROM {doi}), {_quoted(ENTITY_TAIL)}, ''))"


def _found(mode: str) -> str:
    if mode == "doi":
        return f"transform(regexp_extract_all(text, {_quoted(DOI_PATTERN)}, 1), raw -> named_struct('raw', raw, 'id', {_normal_doi('raw')}))"
    compact = "regexp_replace(lower(x), '(?U)\\\\s', '')"
    normal = f"regexp_replace({compact}, '^([^v]*)v[0-9]+\\\\z', '$1')"
    forms = [f"zip_with(regexp_extract_all(text, {_quoted(p)}, 1), regexp_extract_all(text, {_quoted(p)}, 2), (raw, x) -> named_struct('raw', raw, 'id', {normal}))" for p in ARXIV_PATTERNS]
    return f"concat({', '.join(forms)})"


def register(spark: SparkSession) -> None:
    """Adds extract_identifiers to the session. mode: doi or arxiv; any other gives no rows. A null text gives none either.

    Matches are those of doi_matches and arxiv_matches: the first of each identifier stays.
    """
    first = "filter(ms, (m, i) -> array_position(transform(ms, x -> x.id), m.id) = i + 1)"
    matches = f"CASE mode WHEN 'doi' THEN {_found('doi')} WHEN 'arxiv' THEN {_found('arxiv')} END"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION extract_identifiers(text STRING, mode STRING) RETURNS TABLE ({COLUMNS}) RETURN "
        f"SELECT CAST(pos AS BIGINT), m.raw, m.id FROM (SELECT posexplode({first}) AS (pos, m) FROM (SELECT {matches} AS ms))"
    )
