"""DOI extraction and normalisation as Column expressions (all JVM-side)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The identifier pattern (Unicode \s and \d), the escapes that are decoded, the characters
# trimmed from the end and the entity tails that are stripped once each. What may stand before an identifier (doi:, a
# resolver's address) holds no digit, so it neither hides nor makes one, and is not looked for.
DOI_PATTERN = r"""(?U)(10\.\d{4,}/[^\s\]\)>,;"']+)"""
ESCAPES = {"%2[Ff]": "/", "%3[Aa]": ":", "%28": "(", "%29": ")", "%3[Cc]": "<", "%3[Ee]": ">"}
TRAILING = ".,;:)]>\"' "
ENTITY_TAIL = r"(?:&quot)?(?:&amp)?(?:&lt)?(?:&gt)?\z"


def normalize_doi(doi: Column) -> Column:
    """Escapes are decoded, and entities stripped, where there can be any: most identifiers have neither."""
    decoded = doi
    for escape, plain in ESCAPES.items():
        decoded = F.regexp_replace(decoded, escape, plain)
    trimmed = F.rtrim(F.when(doi.contains("%"), decoded).otherwise(doi), F.lit(TRAILING))
    return F.lower(F.when(doi.contains("&"), F.regexp_replace(trimmed, ENTITY_TAIL, "")).otherwise(trimmed))


def doi_prefix(doi: Column) -> Column:
    """Registrant prefix of an identifier, or null when it is not of the form 10.x/y."""
    return F.when(doi.like("10.%/%"), F.lower(F.substring_index(doi, "/", 1)))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once a row however often use mentions it."""
    return F.transform(F.array(value), use)[0]


def keep_first(matches: Column, field: str = "id") -> Column:
    """Drop later elements with an id that an earlier one has. Matches, and their ids, are computed once a row."""
    first = lambda ms, ids: F.filter(ms, lambda m, i: F.array_position(ids, m[field]) == i + 1)
    return bind(matches, lambda ms: bind(F.transform(ms, lambda m: m[field]), lambda ids: first(ms, ids)))


def doi_matches(text: Column) -> Column:
    """array<struct<raw, id>> in text order, one element per normalised DOI."""
    found = F.when(~text.contains("10."), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(text, F.lit(DOI_PATTERN), F.lit(1)))
    return keep_first(F.transform(found, lambda raw: F.struct(raw.alias("raw"), normalize_doi(raw).alias("id"))))
