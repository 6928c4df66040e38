"""JSONL and Parquet outputs."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from citeweave.functions.arxiv import arxiv_id_of_doi
from citeweave.functions.keys import partition_key
from citeweave.functions.provenance import ASSERTED
from citeweave.operators.invert import entry_of_link
from citeweave.schemas import EDGES
from citeweave.scratch import scratch


def split_path(path: str, kind: str) -> str:
    """p.ext -> p_kind.ext, beside the original, in whatever store."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    p = PurePosixPath(name)
    return f"{folder}{slash}{p.stem}_{kind}{p.suffix}"


def split_path_of(path: Column, kind: str) -> Column:
    """split_path of a column of paths."""
    return F.regexp_replace(path, r"^(.*?[^/.][^/]*?)(\.[^./]*)?$", f"$1_{kind}$2")


def cited_by_json(cited_by: Column) -> Column:
    """cited_by with every reference as JSON instead of text; a reference that does not parse becomes null."""
    return F.transform(
        cited_by,
        lambda c: F.struct(
            c.doi.alias("doi"),
            c.provenance.alias("provenance"),
            F.transform(
                c.matches,
                lambda m: F.struct(m.raw_match.alias("raw_match"), F.try_parse_json(m.reference).alias("reference"), m.provenance.alias("provenance")),
            ).alias("matches"),
        ),
    )


def arxiv_head(citations: DataFrame) -> list[Column]:
    """arxiv_doi and arxiv_id; an id that is missing is taken from the DOI."""
    known = F.coalesce("arxiv_id", arxiv_id_of_doi(F.col("doi"))) if "arxiv_id" in citations.columns else arxiv_id_of_doi(F.col("doi"))
    return [F.col("doi").alias("arxiv_doi"), known.alias("arxiv_id")]


def to_jsonl(citations: DataFrame, arxiv: bool = False, keep_null_id: bool = False) -> DataFrame:
    """One JSON text per record, in column value."""
    opaque = isinstance(citations.schema["cited_by"].dataType.elementType, VariantType)
    entries = F.col("cited_by") if opaque else cited_by_json(F.col("cited_by"))
    counts = [F.col("reference_count"), F.col("citation_count"), entries.alias("cited_by")]
    head = [F.col("doi")]
    if arxiv:
        head = arxiv_head(citations)
    elif keep_null_id:
        head.append((F.col("arxiv_id") if "arxiv_id" in citations.columns else F.lit(None).cast("string")).alias("arxiv_id"))
    return citations.select(F.to_json(F.struct(*head, *counts), {"ignoreNullFields": str(not keep_null_id).lower()}).alias("value"))


def json_line(head: Column, entries: Column, keep_null: bool) -> Column:
    """The line of a record: head is a struct of what stands before its entries, entries their JSON, joined by commas."""
    text = F.to_json(head, {"ignoreNullFields": str(not keep_null).lower()})
    return F.concat(F.regexp_replace(text, r"\}$", ',"cited_by":['), entries, F.lit("]}"))


def with_entry_texts(citations: DataFrame) -> DataFrame:
    """Records with opaque entries: instead of cited_by, entries has the JSON of each and whether it is asserted, made once for all outputs."""
    asserted = lambda x: F.coalesce(F.try_variant_get(x, "$.provenance", "string"), F.lit("mined")).isin(*ASSERTED)
    texts = F.transform("cited_by", lambda x: F.struct(F.coalesce(F.to_json(x), F.lit("null")).alias("entry"), asserted(x).alias("asserted")))
    return citations.withColumn("entries", texts).drop("cited_by")


def write_split(citations: DataFrame, path: str, arxiv: bool = False, single: bool = False, compression: str | None = None) -> None:
    """Records of with_entry_texts, and those with the asserted and mined entries alone beside them, counted anew; a directory of JSONL parts each.

    single gives one sorted part (only for small outputs).
    """
    for kind in (None, "asserted", "mined"):
        some = citations
        if kind:
            some = some.withColumn("entries", F.filter("entries", lambda e: e.asserted if kind == "asserted" else ~e.asserted))
            some = some.withColumn("citation_count", F.size("entries").cast("bigint")).where("citation_count > 0")
        if single:
            some = some.repartition(1).sortWithinPartitions(F.desc("citation_count"), F.asc("doi"))
        names = arxiv_head(some) if arxiv else [F.col("doi"), *(["arxiv_id"] if kind else [])]
        line = json_line(F.struct(*names, "reference_count", "citation_count"), F.array_join("entries.entry", ","), kind is not None)
        some.select(line.alias("value")).write.mode("overwrite").option("compression", compression or "none").text(split_path(path, kind) if kind else path)


def write_partitioned_edges(edges: DataFrame, path: str, mode: str = "overwrite", largest_rows: int = 5_000_000) -> None:
    """Keeps edges by partition key, or appends to those kept.

    Rows are dealt out by key first, and AQE parts keys that are larger than its partitions: a key has as many files as
    its bytes need, not one of every task that saw it. A file holds largest_rows at most.
    """
    keyed = edges.withColumn("pkey", partition_key(F.col("cited_id"))).hint("rebalance", F.col("pkey"))
    keyed.write.mode(mode).partitionBy("pkey").option("compression", "zstd").option("maxRecordsPerFile", largest_rows).parquet(path)


def compact_edges(spark: SparkSession, path: str, target: str, largest_rows: int = 100_000_000) -> None:
    """Rewrites kept edges, after many appends, in one file a key; one of more than largest_rows has as many as it needs.

    A task sorts the edges of a file (and spills). target is another folder, which then takes the place of path.
    """
    kept = spark.read.schema(f"{EDGES}, pkey string").parquet(path)
    large = kept.groupBy("pkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > largest_rows)
    shares = F.coalesce(F.ceil(F.col("n") / largest_rows), F.lit(1))
    share = F.pmod(F.xxhash64("citing_doi", "ref_index", "match_ord"), shares)
    dealt = kept.join(F.broadcast(large), "pkey", "left").repartition("pkey", share).select(*kept.columns)
    dealt.write.mode("overwrite").partitionBy("pkey").option("compression", "zstd").option("maxRecordsPerFile", largest_rows).parquet(target)


#: Rows of a row group of ranked output.
RANKED_GROUP = 250_000


def write_inverted(inverted: DataFrame, path: str) -> None:
    """Most cited first, ties by identifier: sorted by ranges, so that the files, in the order of their names, are the ranking.

    No task sorts more than its range; a row group has RANKED_GROUP rows at most.
    """
    ranked = inverted.orderBy(F.desc("citation_count"), F.asc("cited_id"))
    ranked.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", RANKED_GROUP).parquet(path)


#: Rows of parts of hot works that a task sorts.
HOT_ROWS = 4


def write_inverted_links(links: DataFrame, path: str, hot: int = 100_000) -> None:
    """The ranking of stored, deduplicated links, with no array of more than about hot citing works.

    A work of more has a row for each of its parts, in which its citing works are dealt out by a hash; every row has the
    counts of the whole work, cited_by is sorted within a row. Other works have part 0 alone. Works of parts come first
    in the ranking: they are sorted by ranges of their own, a few rows a task, in the same write.
    """
    counts = [F.count(F.lit(1)).alias("citation_count"), F.count(F.lit(1)).alias("reference_count")]
    kept = links.select("cited_id", "citing_doi", "provenance", "raw_match", "ref_json")
    # A row for each hot work: links hold more than hot times as many.
    large = kept.groupBy("cited_id").agg(*counts).where(F.col("citation_count") > hot).withColumn("parts", F.ceil(F.col("citation_count") / hot))
    scratched = scratch(links.sparkSession)
    large.write.parquet(scratched)
    large = links.sparkSession.read.parquet(scratched)
    n_parts = large.agg(F.sum("parts")).first()[0]
    rows = F.array_sort(F.collect_list(entry_of_link())).alias("cited_by")
    rest = kept.join(F.broadcast(large.select("cited_id")), "cited_id", "left_anti") if n_parts else kept
    few = rest.groupBy("cited_id").agg(*counts, rows).withColumns({"part": F.lit(0).cast("bigint"), "parts": F.lit(1).cast("bigint")})
    order, names = [F.desc("citation_count"), F.asc("cited_id")], ["cited_id", "citation_count", "reference_count", "part", "parts", "cited_by"]
    ranked = few.select(names).orderBy(*order)
    if n_parts:
        dealt = kept.join(F.broadcast(large), "cited_id").withColumn("part", F.pmod(F.xxhash64("citing_doi"), F.col("parts")))
        firsts = [F.first(c).alias(c) for c in ("citation_count", "reference_count", "parts")]
        many = dealt.groupBy("cited_id", "part").agg(*firsts, rows).select(names)
        # A part that the hash left empty has a row too: every work has its first.
        none = large.select("cited_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "citation_count", "reference_count", "parts").withColumn("cited_by", F.array().cast(many.schema["cited_by"].dataType))
        many = many.unionByName(none.join(many.select("cited_id", "part"), ["cited_id", "part"], "left_anti"))
        many = many.repartitionByRange(-(-n_parts // HOT_ROWS), *order, F.asc("part")).sortWithinPartitions(*order, F.asc("part"))
        ranked = many.unionByName(ranked)  # partitions of a union stand in its order, and so do the names of their files
    ranked.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", RANKED_GROUP).parquet(path)
