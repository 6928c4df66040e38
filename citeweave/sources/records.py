"""Registry records, identifier indexes and citation files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.functions.doi import doi_prefix
from citeweave.operators.index import build_index, index_prefixes
from citeweave.storage import exists, remove


def _string(variant: str, field: str):
    """A string field of a variant; null for other types."""
    value = F.expr(f"variant_get({variant}, '$.{field}')")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(variant, f"$.{field}", "string"))


def blank(line: Column) -> Column:
    """A line of white space alone, of any kind."""
    return ~line.rlike(r"(?U)\S")


def read_records(spark: SparkSession, path: str, id_field: str = "id") -> DataFrame:
    """Index of the string ids of a (compressed) JSONL file. Blank and malformed lines and other ids are ignored."""
    lines = spark.read.text(path).where(~blank(F.col("value"))).select(F.try_parse_json("value").alias("v"))
    return build_index(lines.where(F.col("v").isNotNull()).select(_string("v", id_field).alias("doi")))


#: Ranges of identifiers to which a scan of an index is narrowed at most.
INDEX_RANGES = 64
#: Rows of a row group of a stored index.
INDEX_GROUP = 100_000


def read_index(spark: SparkSession, path: str, probes: DataFrame | None = None, column: str = "doi") -> DataFrame:
    """A stored index; lower-cased, as probes are.

    With probes, only what can match them is read: prefixes that both have, known from the small table beside the index,
    are covered by a few ranges, which Parquet compares with the bounds of its row groups. The join decides the rest.
    """
    index = spark.read.parquet(path)
    ranges = None if probes is None else probed_ranges(spark, path, probes, column)
    if ranges is not None:
        near = [(F.col("doi") >= f"{low}/") & (F.col("doi") < f"{high}0") for low, high in ranges]  # 0 follows the slash
        index = index.where(reduce(lambda a, b: a | b, near, F.lit(False)))
    return build_index(index)


def read_prefixes(spark: SparkSession, path: str) -> DataFrame:
    """The prefixes stored beside an index, or, where there are none, those of its identifiers."""
    beside = prefix_path(path)
    return spark.read.schema("prefix string").parquet(beside).distinct() if exists(spark, beside) else index_prefixes(read_index(spark, path))


def prefix_path(path: str) -> str:
    return f"{path.rstrip('/')}.prefixes"


def probed_ranges(spark: SparkSession, path: str, probes: DataFrame, column: str) -> list[tuple[str, str]] | None:
    """At most INDEX_RANGES ranges of prefixes, ends included, that cover those of probes in the index.

    None if nothing can be told: without the table of prefixes, or where letters of either case make their order unsure.
    """
    if not exists(spark, prefix_path(path)):
        return None
    known = read_prefixes(spark, path).join(probes.select(doi_prefix(F.lower(column)).alias("prefix")).distinct(), "prefix", "left_semi")
    tile = F.ntile(INDEX_RANGES).over(Window.orderBy("prefix"))  # a prefix a registrant: some 100,000 at most
    tiles = known.select("prefix", tile.alias("tile")).groupBy("tile").agg(F.min("prefix").alias("low"), F.max("prefix").alias("high"), F.bool_or(F.col("prefix").rlike(r"[^0-9.]")).alias("unsure"))
    found = tiles.orderBy("tile").collect()
    return None if any(r["unsure"] for r in found) else [(r["low"], r["high"]) for r in found]


def write_index(index: DataFrame, path: str) -> None:
    """Identifiers in order, so that a row group holds few prefixes, with a Bloom filter for single ones; their prefixes beside them."""
    ordered = index.select("doi").repartitionByRange("doi").sortWithinPartitions("doi")
    ordered.write.mode("overwrite").option("compression", "zstd").option("parquet.bloom.filter.enabled#doi", "true").option("parquet.block.row.count.limit", INDEX_GROUP).parquet(path)
    index_prefixes(index.sparkSession.read.parquet(path)).write.mode("overwrite").option("compression", "zstd").parquet(prefix_path(path))


CITATION = "doi string, arxiv_doi string, arxiv_id string, reference_count bigint, citation_count bigint, cited_by array<variant>"


def _whole(r: Column) -> Column:
    """Whether a parsed record has all that it must have."""
    return F.coalesce(r.doi, r.arxiv_doi).isNotNull() & r.reference_count.isNotNull() & r.citation_count.isNotNull() & r.cited_by.isNotNull()


def _whole_lines(spark: SparkSession, path: str, without: Sequence[str]) -> DataFrame:
    lines = spark.read.text(path)
    if without:
        lines = lines.where(~F.col("_metadata.file_path").isin(list(without)))
    return lines.where(~blank(F.col("value")))


def read_citations(spark: SparkSession, path: str, without: Sequence[str] = ()) -> DataFrame:
    """Citation records, but for those of the files named by without; a malformed line or one without doi, counts or cited_by fails the job. bad_records says which.

    Entries of cited_by are opaque (variants): fields that this engine does not know pass through. Lines of white space
    alone, of any kind, are skipped.
    """
    rows = _whole_lines(spark, path, without).select("value", F.from_json("value", CITATION, {"mode": "FAILFAST"}).alias("r"))
    said = F.concat(F.lit("citation record lacks a required field: "), F.substring("value", 1, 200))
    checked = F.when(_whole(F.col("r")), F.coalesce("r.doi", "r.arxiv_doi")).otherwise(F.raise_error(said))
    return rows.select(checked.alias("doi"), "r.arxiv_id", "r.reference_count", "r.citation_count", "r.cited_by")


#: What stands before a line's first entry, and before an entry's or a line's first value.
LAST_OF_HEAD, FIRST_VALUE = '"cited_by":[', '{"doi":'


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Written lines with their place, cut before each entry, so that none is whole in memory however many entries it has."""
    rows = _lines(spark, path, FIRST_VALUE)
    return rows.withColumn("is_head", F.rtrim("value").endswith(LAST_OF_HEAD))


#: Bytes between two entries beyond which a text is none of this engine's, and not held to look for its heads.
LONGEST_PIECE = 64 << 20


def _is_whole_head() -> Column:
    """A head of doi, behind which entries follow or, with none, the line's end."""
    text = F.rtrim(F.translate("value", "\n\r\t", "   "))
    # Most pieces are entries, which the first test sorts out.
    return F.col("value").contains(LAST_OF_HEAD) & ~F.col("value").contains('{"arxiv_doi":') & (text.endswith(LAST_OF_HEAD) | text.endswith(LAST_OF_HEAD + "]}"))


LONG_HEAD = "doi string, arxiv_id string, reference_count bigint, citation_count bigint"


def _long_head() -> Column:
    return F.from_json(F.concat(F.lit(FIRST_VALUE), "value", F.lit("]}")), LONG_HEAD)


def files_of_hot(spark: SparkSession, path: str, hot: int) -> list[str]:
    """Citation files with doi heads that count more than hot citing works: a name for each, which has a line of that many at least."""
    pieces = spark.read.option("mapreduce.input.linerecordreader.line.maxlength", LONGEST_PIECE).text(path, lineSep=FIRST_VALUE)
    # Heads of as many digits alone are parsed.
    pieces = pieces.where(F.col("value").contains(LAST_OF_HEAD) & F.col("value").rlike(rf'"citation_count"\s*:\s*[0-9]{{{len(str(hot))}}}'))
    found = pieces.where(_is_whole_head()).where(_long_head().citation_count > hot)
    return sorted(r[0] for r in found.select("_metadata.file_path").distinct().collect())


def read_long_citations(spark: SparkSession, path: str, files: Sequence[str], target: str) -> tuple[DataFrame, DataFrame]:
    """Records of files in this engine's layout whose lines may be of any length: heads, by line, and entries as JSON, by line and nth.

    An entry is of the last head before it, as in read_entries. Pieces are stored below target first, as their place is
    that of one reading; they go when entries are stored. What is no head and no JSON either fails the job.
    """
    rows = _lines(spark, path, FIRST_VALUE, files).withColumn("is_head", _is_whole_head())
    rows = rows.withColumn("line", _carried(F.when(F.col("is_head"), F.col("at")), "bigint"))
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/pieces")
    rows = spark.read.parquet(f"{target}/pieces")
    heads = rows.where("is_head").select("line", _long_head().alias("r"), "value")
    whole = F.col("r.doi").isNotNull() & F.col("r.reference_count").isNotNull() & F.col("r.citation_count").isNotNull()
    said = F.concat(F.lit("citation record lacks a required field: "), F.substring("value", 1, 200))
    heads = heads.select("line", F.when(whole, F.col("r.doi")).otherwise(F.raise_error(said)).alias("doi"), "r.arxiv_id", "r.reference_count", "r.citation_count")
    heads.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/heads")
    entries = rows.where(~F.col("is_head")).join(F.broadcast(_heads_before(rows)), ["file", "split"], "left")
    # Behind an entry there is a comma or the end of its line.
    entry = F.concat(F.lit(FIRST_VALUE), F.regexp_replace("value", r"(?:,|\]\})\s*\z", ""))
    entries = entries.select(F.coalesce("line", "head_at").alias("line"), F.struct("split", "at").alias("nth"), entry.alias("entry"), F.try_parse_json(entry).alias("parsed"))
    bad = F.raise_error(F.concat(F.lit("citation record with an entry that is no JSON: "), F.substring("entry", 1, 200)))
    provenance = F.try_variant_get("parsed", "$.provenance", "string")
    checked = F.when(F.col("parsed").isNull() | F.col("line").isNull(), bad).otherwise(F.col("entry"))
    entries.select("line", "nth", checked.alias("entry"), provenance.alias("provenance")).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/entries")
    remove(spark, f"{target}/pieces")
    return spark.read.parquet(f"{target}/heads"), spark.read.parquet(f"{target}/entries")


def _head(keys: list[str]) -> Column:
    arxiv = '{"arxiv_doi":'
    begin = F.concat(F.lit(arxiv), F.substring_index("value", arxiv, -1)) if "arxiv_doi" in keys else F.concat(F.lit(FIRST_VALUE), "value")
    return F.from_json(F.concat(begin, F.lit("]}")), ", ".join(f"{k} string" for k in keys))


def read_heads(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """What the lines of an output of this engine say of their works, as text; a line of any length will do.

    For lines as sinks write them: a reference within them that ends like a head would be taken for one.
    """
    return _pieces(spark, path).where("is_head").select(_head(keys).alias("h")).select("h.*")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """(work, nth, entry) of an output of this engine with doi heads: JSON of each entry, behind which something may follow, and its place.

    An entry is of the last head before it: in its split of the file, where it is carried on from row to row, or, if there
    is none, in the splits before, of which a row each says what they end with. Entries are neither shuffled nor sorted.
    """
    pieces = _pieces(spark, path)
    work = F.when(F.col("is_head"), _head(["doi"]).doi)
    known = pieces.where("is_head").select(F.col("at").alias("head_at"), work.alias("before"))
    before = known.join(F.broadcast(_heads_before(pieces)), "head_at").drop("head_at")
    entries = pieces.withColumn("work", _carried(work, "string")).where(~F.col("is_head")).join(F.broadcast(before), ["file", "split"], "left")
    return entries.select(F.coalesce("work", "before").alias("work"), F.struct("split", "at").alias("nth"), F.concat(F.lit(FIRST_VALUE), "value").alias("entry"))


def _carried(value: Column, kind: str) -> Column:
    """value or, where it is null, that of the last row before it in its split of a file that has one.

    For rows as _lines has them: the rows of a split are one task's, in their order, so it passes on one value and no row
    moves. Only a hash of the split and value go to Python.
    """

    def carry(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        place, last = None, None
        for places, values in batches:
            if not len(places):
                yield values
                continue
            starts = [0, *(k + 1 for k in pc.indices_nonzero(pc.not_equal(places[1:], places[:-1])).to_pylist()), len(places)]
            parts = []
            for a, b in zip(starts, starts[1:]):
                if places[a].as_py() != place:
                    place, last = places[a].as_py(), None
                filled = pc.fill_null_forward(pa.concat_arrays([pa.array([last], values.type), values[a:b]]))
                last = filled[-1].as_py()
                parts.append(filled[1:])
            yield pa.concat_arrays(parts)

    # Not deterministic, as it hangs on the rows before: Spark then moves no filter below it.
    return F.arrow_udf(carry, kind).asNondeterministic()(F.xxhash64("file", "split"), value)


def _heads_before(pieces: DataFrame) -> DataFrame:
    """(file, split, head_at): the place of the last head before a split, for splits behind one. A row a split is what is counted."""
    ends = pieces.groupBy("file", "split").agg(F.max(F.when(F.col("is_head"), F.col("at"))).alias("end"))
    before = F.last("end", True).over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    return ends.select("file", "split", before.alias("head_at")).where(F.col("head_at").isNotNull())


def _lines(spark: SparkSession, path: str, end: str | None = None, files: Sequence[str] | None = None) -> DataFrame:
    """Lines that are not blank, with their place: file, split and, within it, an ascending number."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at")]
    lines = spark.read.text(path, lineSep=end)
    if files is not None:
        lines = lines.where(F.col("_metadata.file_path").isin(list(files)))
    return lines.select(*place, "value").where(~blank(F.col("value")))


def _numbered(lines: DataFrame) -> DataFrame:
    """Replaces the place by number, from 1 within a file.

    Files are read in splits: each split's lines are counted, the counts before a split give its first number, and lines
    stand in a split in their order. No task holds more than a split.
    """
    sizes = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("file", "split", (F.sum("n").over(Window.partitionBy("file").orderBy("split")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("file", "split").orderBy("at"))
    numbered = lines.withColumn("nth", nth).join(before, ["file", "split"])
    return numbered.withColumn("number", (F.col("before") + F.col("nth")).cast("bigint")).drop("split", "at", "before", "nth")


def numbered_records(spark: SparkSession, path: str) -> DataFrame:
    """file, number and value of every line that is not blank."""
    return _numbered(_lines(spark, path)).select("file", "number", "value")


def bad_records(spark: SparkSession, path: str) -> DataFrame:
    """file, number, reason and value of the records that read_citations refuses; texts of good ones are not moved."""
    parsed = F.from_json("value", f"{CITATION}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    reason = F.when(F.col("r").isNull() | F.col("r._corrupt").isNotNull(), "malformed").when(~_whole(F.col("r")), "lacks a required field")
    judged = _lines(spark, path).withColumn("r", parsed).withColumn("reason", reason)
    light = judged.select("file", "split", "at", "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"))
    return _numbered(light).where("reason IS NOT NULL").select("file", "number", "reason", "value")


def first_bad_record(spark: SparkSession, path: str) -> str | None:
    """What is wrong with the first record that is refused, with its number; none if all are good."""
    found = bad_records(spark, path).select("file", "number", "reason").orderBy("file", "number").first()
    return found and f"failed to parse record at line {found['number']} of {found['file']}: {found['reason']}"
