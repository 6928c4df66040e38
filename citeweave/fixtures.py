"""Reference corpus derived from the order tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CORPUS = """
works AS (
  SELECT o_orderkey AS k,
         concat('10.', CAST(1000 + o_orderkey % 40 AS STRING), '/w', CAST(o_orderkey AS STRING)) AS doi
  FROM {orders}),
r0 AS (
  SELECT l_orderkey AS k, l_linenumber, l_partkey, l_suppkey, l_partkey % 14 AS kind,
         CASE WHEN l_suppkey % 23 = 0 THEN l_orderkey
              WHEN l_partkey % 11 = 0 THEN l_suppkey % 10
              ELSE (l_orderkey * 7 + (l_partkey % 3) * 101) % {n} END AS ck,
         concat(CAST(2401 + l_suppkey % 12 AS STRING), '.', lpad(CAST(l_partkey AS STRING), 5, '0')) AS ax,
         CAST(l_partkey AS STRING) AS p
  FROM {lineitem}),
r1 AS (
  SELECT r0.*, concat(CAST(1000 + ck % 40 AS STRING), '/w', CAST(ck AS STRING)) AS tgt FROM r0),
refs AS (
  SELECT works.doi AS citing_doi, CAST(0 AS BIGINT) AS entry_ord, r1.k AS item_ord, kind,
    CAST(row_number() OVER (PARTITION BY r1.k ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS BIGINT) AS ref_index,
    CASE WHEN kind IN (0, 1, 2) THEN concat('10.', upper(tgt))
         WHEN kind = 7 THEN concat('10.48550/arXiv.', ax) END AS doi_field,
    CASE WHEN kind IN (0, 7) THEN 'publisher' WHEN kind = 1 THEN 'crossref' END AS asserted_by,
    CASE WHEN kind = 10 THEN concat('http://dx.doi.org/10.', tgt) END AS url,
    CASE WHEN kind = 6 THEN concat('arXiv: ', ax, 'v2') END AS article_title,
    CASE WHEN kind = 9 THEN 'arXiv' END AS journal_title,
    CASE kind
      WHEN 2  THEN concat('again doi:10.', tgt, ', and 10.5061/p', p)
      WHEN 3  THEN concat('See https://doi.org/10.', tgt, '. Accessed')
      WHEN 4  THEN concat('doi:10.5061/P', p, '), 2nd ed.')
      WHEN 5  THEN concat('arXiv:hep-ph/', lpad(p, 7, '0'), ' and https://arxiv.org/abs/', ax)
      WHEN 8  THEN 'no identifier here'
      WHEN 9  THEN concat(ax, ' preprint')
      WHEN 11 THEN concat('10.5061/p', p, '&gt; x')
      WHEN 12 THEN concat('10.5061/a%2Fb', p, '.')
      WHEN 13 THEN concat('10.1016/S0140-6736(05)', p) END AS unstructured,
    '' AS ref_json
  FROM r1 JOIN works ON works.k = r1.k),
idx_a AS (SELECT DISTINCT lower(doi) AS doi FROM works),
idx_b AS (
  SELECT DISTINCT concat('10.5061/p', CAST(p_partkey AS STRING)) AS doi FROM {part} WHERE p_partkey % 2 = 0
  UNION
  SELECT DISTINCT lower(concat('10.48550/arXiv.', ax)) AS doi FROM r0 WHERE kind IN (5, 6, 7, 9) AND l_suppkey % 3 = 0)
"""


#: Order lines of a task, so that what a task sorts stays as it is however many lines there are.
TASK_LINES = 500_000


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the order lines: from the footers alone, the cores at least."""
    return max(spark.sparkContext.defaultParallelism, -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // TASK_LINES))


def _sql(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem", "part")}
    # A small file is one row group and so one task; dealt out by the work, which the numbering of references needs anyway.
    tables["lineitem"] = tables["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(tasks(spark, sf_dir), "l_orderkey")
    n = tables["orders"].count() * 4 // 3  # from the footers alone, and one number in the plan
    # Keys in order make a small file of many rows, whose broadcast would grow with them: a hint to Spark's planner alone.
    corpus = CORPUS.replace("{n}", str(n)).replace("SELECT works.doi AS citing_doi", "SELECT /*+ MERGE(works) */ works.doi AS citing_doi")
    return spark.sql(f"WITH {corpus} {select}", **tables)


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "SELECT * FROM refs")


def by_pair(spark: SparkSession, sf_dir: str, edges: DataFrame) -> DataFrame:
    """Edges dealt out by what dedup compares, which then needs neither an exchange of its own nor a sort in front of one."""
    return edges.repartition(tasks(spark, sf_dir), "citing_doi", "cited_id")


def index_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "SELECT * FROM idx_a")


def index_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "SELECT * FROM idx_b")


def duckdb_corpus() -> str:
    n = "(SELECT CAST(floor(count(*) * 4 / 3) AS BIGINT) FROM orders)"
    return CORPUS.format(orders="orders", lineitem="lineitem", part="part", n=n)
