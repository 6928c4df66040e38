"""JSONL of inverted works from links, without an array of a hot work's citing works anywhere.

Works of few citing works are gathered and written a row each. A hot work's line is put together by the writer: its head,
one row for each citing work, and its end, sorted by Spark, which spills, and joined by blanks, which JSON ignores.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.scratch import scratch
from citeweave.sinks.outputs import arxiv_head, json_line, split_path

#: Citing works beyond which a work is hot.
HOT = 100_000
#: Links that a task gathers, so that what it holds stays as it is however many there are.
TASK_LINKS = 250_000
#: Lines of a compressed file, but for those of hot works.
FILE_LINES = 50_000
ASSERTED = ("publisher", "crossref")


def link_entry(citing: Column, provenance: Column, raw: Column, reference: Column) -> Column:
    """The entry of a citing work in cited_by; reference is parsed, and null if it was no JSON."""
    match = F.struct(raw.alias("raw_match"), reference.alias("reference"), provenance.alias("provenance"))
    return F.struct(citing.alias("doi"), provenance.alias("provenance"), F.array(match).alias("matches"))


def _json(value: Column, keep_null: bool) -> Column:
    return F.to_json(value, {"ignoreNullFields": str(not keep_null).lower()})


@dataclass
class Gathered:
    """Links by work, stored: a row with all its entries for each work of few, the links themselves for hot ones.

    An entry is JSON, made once for all outputs; bare is its form without null fields where it has any.
    """

    few: DataFrame
    many: DataFrame
    hot: DataFrame | None


def _asserted(provenance: Column) -> Column:
    return F.coalesce(provenance, F.lit("mined")).isin(*ASSERTED)


def gather(links: DataFrame, works: DataFrame, hot: int = HOT) -> Gathered:
    """Links of works, shuffled once for however many outputs are then written of them, each in a narrow pass.

    Links are counted for the number of tasks, which takes the footers alone if they are stored.
    """
    spark, path = links.sparkSession, scratch(links.sparkSession)
    # Links of no work go in any case; left out first, sizes and works can count the same rows in one exchange.
    kept = links.select("cited_id", "citing_doi", "provenance", "raw_match", "ref_json").where(F.col("cited_id").isNotNull())
    tasks, works = max(spark.sparkContext.defaultParallelism, -(-links.count() // TASK_LINKS)), works.drop("citation_count")
    # Written first: one row a work, and one a hot work, so the planner sees how few are hot and need not deal out links to find theirs.
    sizes = kept.groupBy("cited_id").agg(F.count(F.lit(1)).alias("n_links")).join(works.withColumn("wanted", F.lit(True)), "cited_id", "left")
    sizes.write.option("compression", "zstd").parquet(f"{path}/sizes")
    sizes = spark.read.parquet(f"{path}/sizes")
    large, wanted = F.col("n_links") > hot, sizes.where("wanted").drop("wanted")
    sizes.where(large).write.parquet(f"{path}/large")
    every_hot = spark.read.parquet(f"{path}/large")
    rest = kept if every_hot.isEmpty() else kept.join(every_hot.select("cited_id"), "cited_id", "left_anti")
    # Dealt out as links, which are shorter than their entries.
    dealt = rest.repartition(tasks, "cited_id").withColumn("reference", F.try_parse_json("ref_json"))
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("citing_doi", "provenance", "raw_match", "reference")])
    entry = link_entry(*map(F.col, ("citing_doi", "provenance", "raw_match", "reference")))
    dealt = dealt.select("cited_id", F.struct("citing_doi", _asserted(F.col("provenance")).alias("asserted"), _json(entry, True).alias("entry"), F.when(has_null, _json(entry, False)).alias("bare")).alias("r"))
    rows = F.transform(F.array_sort(F.collect_list("r")), lambda r: r.dropFields("citing_doi"))
    dealt.groupBy("cited_id").agg(rows.alias("rows")).join(wanted.where(~large), "cited_id").write.option("compression", "zstd").parquet(f"{path}/few")
    many = every_hot.where("wanted").drop("wanted")
    if many.isEmpty():
        return Gathered(spark.read.parquet(f"{path}/few"), many, None)
    kept.join(many.select("cited_id"), "cited_id", "left_semi").write.option("compression", "zstd").parquet(f"{path}/hot")
    return Gathered(spark.read.parquet(f"{path}/few"), many, spark.read.parquet(f"{path}/hot"))


def write_gathered(links: Gathered, path: str, kind: str | None = None, arxiv: bool = False, only: Column | None = None, single: bool = False, compression: str | None = None) -> None:
    """One JSON line for each work with a link, or of those that only is true of; see write_lines."""
    keep_null, chosen = kind is not None, F.lit(True) if only is None else only
    of_kind = (lambda p: F.lit(True)) if kind is None else _asserted if kind == "asserted" else (lambda p: ~_asserted(p))

    def head(works: DataFrame) -> Column:
        names = arxiv_head(works) if arxiv else [F.col("doi"), *([F.lit(None).cast("string").alias("arxiv_id")] if keep_null else [])]
        return F.struct(*names, "reference_count", "citation_count")

    few = links.few.where(chosen)
    if kind:
        few = few.withColumn("rows", F.filter("rows", lambda r: r.asserted if kind == "asserted" else ~r.asserted))
    few = few.withColumn("citation_count", F.size("rows").cast("bigint")).where("citation_count > 0")
    entries = F.col("rows.entry") if keep_null else F.transform("rows", lambda r: F.coalesce(r.bare, r.entry))
    lines = few.select("cited_id", "citation_count", json_line(head(few), F.array_join(entries, ","), keep_null).alias("value"))
    if single:
        lines = lines.repartition(1).sortWithinPartitions(F.desc("citation_count"), F.asc("cited_id"))
    largest = 0 if compression is None or single else FILE_LINES  # a compressed file is one task's to read
    lines.select("value").write.mode("overwrite").option("compression", compression or "none").option("maxRecordsPerFile", largest).text(path)
    if links.hot is not None and not (many := links.many.where(chosen)).isEmpty():
        hot = links.hot.where(of_kind(F.col("provenance")))
        sizes = hot.groupBy("cited_id").agg(F.count(F.lit(1)).alias("citation_count"), F.min("citing_doi").alias("least"))
        many = many.join(sizes, "cited_id")
        stored = scratch(many.sparkSession)
        many.withColumn("head", head(many)).select("cited_id", "citation_count", "least", "head").write.parquet(stored)
        many = many.sparkSession.read.parquet(stored)  # a row a hot work, as the planner then sees
        _hot_lines(hot, many, keep_null).write.mode("append").option("compression", compression or "none").option("lineSep", " ").text(path)


def write_lines(links: DataFrame, works: DataFrame, path: str, kind: str | None = None, arxiv: bool = False, hot: int = HOT, single: bool = False, compression: str | None = None) -> None:
    """links: deduplicated edges; works: cited_id, doi, reference_count and, for arXiv, arxiv_id.

    One JSON line for each of the works with a link; kind asserted or mined takes those links alone, counts them anew and
    leaves out works without any. Entries stand in the order of their citing DOIs. single gives one sorted part, for
    small outputs, and one more if there are hot works. A file of hot works ends in a blank behind its last line.
    """
    write_gathered(gather(links, works, hot), path, kind, arxiv, single=single, compression=compression)


def _hot_lines(found: DataFrame, many: DataFrame, keep_null: bool) -> DataFrame:
    """Pieces of lines in the order of the lines; a work's pieces are one partition's, and stream through it.

    Links are sorted as they are, and become JSON behind the sort. There are more tasks than works of HOT could fill.
    """
    tasks = 4 * -(-(many.agg(F.sum("citation_count")).first()[0] or 0) // HOT) or 1
    head = F.regexp_replace(_json(F.col("head"), keep_null), r"\}$", ',"cited_by":[')
    ends = many.select("cited_id", "least", F.inline(F.array(F.struct(F.lit(0).alias("nth"), head.alias("value")), F.struct(F.lit(2).alias("nth"), F.lit("]}\n").alias("value")))))
    inner = found.join(many.select("cited_id", "least"), "cited_id").select("cited_id", F.lit(1).alias("nth"), (F.col("citing_doi") == F.col("least")).alias("first"), "citing_doi", "provenance", "raw_match", "ref_json")
    dealt = inner.unionByName(ends.withColumn("citing_doi", F.lit("")).drop("least"), allowMissingColumns=True).repartition(tasks, "cited_id")
    entry = F.concat(F.when(F.col("first"), "").otherwise(","), _json(link_entry(*map(F.col, ("citing_doi", "provenance", "raw_match")), F.try_parse_json("ref_json")), keep_null))
    return dealt.sortWithinPartitions("cited_id", "nth", "citing_doi").select(F.when(F.col("nth") == 1, entry).otherwise(F.col("value")).alias("value"))


def append_long_split(heads: DataFrame, entries: DataFrame, path: str, compression: str | None = None) -> None:
    """Appends records with doi heads to outputs that there are, all entries and the asserted and mined ones, without an array of them.

    heads: line, doi, arxiv_id, reference_count, citation_count; entries: line, nth, entry (JSON), provenance.
    """
    for kind in (None, "asserted", "mined"):
        chosen = entries if kind is None else entries.where(_asserted(F.col("provenance")) if kind == "asserted" else ~_asserted(F.col("provenance")))
        sizes = chosen.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("least"))
        many = heads.join(sizes, "line", "left" if kind is None else "inner")
        count = F.col("citation_count") if kind is None else F.col("n")
        head = F.struct("doi", *([] if kind is None else ["arxiv_id"]), "reference_count", count.alias("citation_count"))
        begin = F.regexp_replace(_json(head, kind is not None), r"\}$", ',"cited_by":[')
        ends = many.select("line", F.inline(F.array(F.struct(F.lit(0).alias("place"), begin.alias("value")), F.struct(F.lit(2).alias("place"), F.lit("]}\n").alias("value")))))
        entry = F.concat(F.when(F.col("nth") == F.col("least"), "").otherwise(","), "entry")
        inner = chosen.join(many.select("line", "least"), "line").select("line", F.lit(1).alias("place"), "nth", entry.alias("value"))
        dealt = inner.unionByName(ends, allowMissingColumns=True).repartition("line").sortWithinPartitions("line", "place", "nth")
        dealt.select("value").write.mode("append").option("compression", compression or "none").option("lineSep", " ").text(split_path(path, kind) if kind else path)


def write_gathered_split(links: Gathered, path: str, arxiv: bool = False, only: Column | None = None, single: bool = False, compression: str | None = None) -> None:
    """All links, and the asserted and mined ones beside them."""
    write_gathered(links, path, None, arxiv, only, single, compression)
    for kind in ("asserted", "mined"):
        write_gathered(links, split_path(path, kind), kind, arxiv, only, single, compression)


def write_lines_split(links: DataFrame, works: DataFrame, path: str, arxiv: bool = False, hot: int = HOT, single: bool = False, compression: str | None = None) -> None:
    write_gathered_split(gather(links, works, hot), path, arxiv, None, single, compression)
