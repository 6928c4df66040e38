"""Registered queries of the operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import collocations, filter_audit, jaccard, language, license_scan, line_dedup, media, mixing, packing, pii, quality, repair, url_filter

# The rules of the URL query, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "phash"]
    return media.text_media(_documents(spark, sf_dir)).select(columns)


def op3_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return repair.encode_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter.judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(_documents(spark, sf_dir).select("doc_id", "text"), "an example key")


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "source", "mix_weight", "mix_epoch", "mix_block", "mix_slot")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


def op9_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(_documents(spark, sf_dir), jaccard.Join(k=3, percent=90))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_documents(spark, sf_dir))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_documents(spark, sf_dir))
    return found.withColumn("n_blocks", F.size("blocks").cast("bigint")).drop("blocks")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    operators = (
        op1_quality_rules, op2_media_columns, op3_token_id_output, op4_url_filters, op5_pii_surrogates,
        op6_temperature_mixing, op7_line_dedup, op8_language_id, op9_retrieval_packing, op10_ngram_jaccard_join,
        op11_filter_audit, op12_collocations, op13_license_scan, pipeline,
    )
    return {f.__name__: f for f in operators}


OP4_SQL = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (SELECT p.page_id, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS nth
      FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM p LEFT JOIN f ON f.page_id = p.page_id AND f.nth = 1
"""


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
m AS (SELECT doc_id, part,
             (len(words) < 50)::INT + 2 * (100 * list_unique(words) < 65 * len(words))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (min(doc_id) OVER (PARTITION BY t) < doc_id)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
h AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) t(step)),
r AS (SELECT part, filter_order, step, bit,
             sum(n * ((mask & (before | bit)) = 0)::INT) AS kept, sum(n * ((mask & bit) > 0 AND (mask & before) = 0)::INT) AS removed,
             sum(n * ((mask & bit) > 0 AND (mask & before) > 0)::INT) AS redundant, sum(n * (mask = bit)::INT) AS unique_fails,
             sum(good * ((mask & bit) > 0 AND (mask & before) = 0)::INT) AS good_lost, sum(toxic * ((mask & bit) > 0 AND (mask & before) = 0)::INT) AS toxic_lost
      FROM h, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""

OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase FROM w, range(1, 5) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT c.*, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp FROM c, range(1, 4) t(j) WHERE j < k),
s AS (SELECT x.*, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = lp JOIN f r ON r.lang = x.lang AND r.phrase = rp),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT DISTINCT c.lang, c.a, array_to_string(c.w[q:q + z - 1], ' ') AS phrase FROM c, range(2, 4) t(z), range(1, 4) u(q) WHERE z < c.k AND q + z - 1 <= c.k),
y AS (SELECT lang, phrase, max(a) AS most FROM i GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, n.n, b.score
FROM b JOIN n ON n.lang = b.lang LEFT JOIN y ON y.lang = b.lang AND y.phrase = b.phrase
WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * b.a QUALIFY rank <= 2000
"""


def _op13_sql() -> str:
    """Every window of every text against every template, without filters."""
    s = license_scan.Scan()
    rows = []
    for k, (label, text) in enumerate(s.templates):
        tokens = {w.decode() for w in license_scan.words_of(text.encode())}
        rows += [f"({k}, '{label}', '{t}', {license_scan.block_width(text)}, {len(tokens)}, {license_scan.needed(len(tokens), s.percent)})" for t in sorted(tokens)]
    base = " OR ".join(
        f"(label = '{label}' AND " + " AND ".join([f"w = '{w}'" if k == 0 else f"lead(w, {k}) OVER o = '{w}'" for k, w in enumerate(phrase.split(" "))]) + ")" for phrase, label in s.phrases
    )
    labels = ", ".join(f"('{label}')" for _, label in s.phrases)
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM d),
q AS (SELECT doc_id, i, label FROM p, (VALUES {labels}) AS t(label) WINDOW o AS (PARTITION BY doc_id, label ORDER BY i) QUALIFY {base}),
t(k, label, token, width, size, need) AS (VALUES {", ".join(rows)}),
h AS (SELECT doc_id, k, label, size, need, unnest([i // (width // 2), i // (width // 2) - 1]) AS block, token FROM p JOIN t ON t.token = p.w),
c AS (SELECT doc_id, k, label, block, count(DISTINCT token) / any_value(size) AS share FROM h WHERE block >= 0 GROUP BY doc_id, k, label, block HAVING count(DISTINCT token) >= any_value(need)),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM q GROUP BY 1),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM q UNION SELECT doc_id, label FROM c) GROUP BY 1),
s AS (SELECT doc_id, max(share) AS share, count(*) AS n FROM c GROUP BY 1)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score, coalesce(n, 0) AS n_blocks
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN s USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filters": OP4_SQL, "op11_filter_audit": OP11_SQL, "op12_collocations": OP12_SQL, "op13_license_scan": _op13_sql()}
