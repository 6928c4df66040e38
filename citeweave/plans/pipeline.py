"""The two end-to-end plans: extract -> invert -> validate -> write, and validate alone."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citeweave.functions.arxiv import arxiv_doi
from citeweave.operators.extract import explode_references, extract_edges
from citeweave.operators.invert import dedup_links, link_counts
from citeweave.operators.resolve import Resolver, head_status, resolve_unmatched
from citeweave.operators.validate import lookup
from citeweave.schemas import EDGES
from citeweave.scratch import scratch
from citeweave.sinks.lines import HOT, append_long_split, gather, write_gathered_split
from citeweave.sinks.outputs import with_entry_texts, write_partitioned_edges, write_split
from citeweave.sources.edges import read_partitioned_edges
from citeweave.sources.records import files_of_hot, first_bad_record, read_citations, read_index, read_long_citations, read_records, write_index
from citeweave.sources.works import items, scan_archives, scan_directory, works_index
from citeweave.storage import digest, exists, names, remove
from citeweave.streaming.commits import CommitLog, key_range
from citeweave.streaming.incremental import read_links
from citeweave.streaming.manifest import PHASES, Manifest

SOURCES = ("all", "crossref", "datacite", "arxiv")
#: Of a row group of a stage's table: a task of the next stage reads one at least.
GROUP_BYTES = 16 << 20
#: Into how many shares the links of a key range are dealt out, each of which one task deduplicates and writes.
SHARES = 64


@dataclass
class PipelineArgs:
    input: str
    source: str = "all"
    datacite_records: str | None = None
    outputs: dict[str, str] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    http_fallback: tuple[str, ...] = ()
    load_index: dict[str, str] = field(default_factory=dict)
    save_index: dict[str, str] = field(default_factory=dict)
    concurrency: int = 50
    timeout: float = 5.0
    keep_intermediates: bool = False
    #: A run of this name goes on where it ended; its intermediates are kept until it is complete.
    run_id: str | None = None
    temp_dir: str | None = None
    single_file: bool = False
    #: Key ranges of a named run, and how many of them are inverted and committed at once.
    ranges: int = 64
    ranges_at_once: int = 8
    #: Where answers of the resolver are remembered, and how often passing errors are asked again.
    resolved_table: str | None = None
    retries: int = 0
    #: Citing works beyond which a work's line is written without gathering them.
    hot: int = HOT
    #: Of the JSONL outputs, a codec that Spark's text writer knows.
    compression: str | None = None

    def check(self) -> None:
        """Raises ValueError when the source lacks an output or the index that it is checked against."""
        if self.source not in SOURCES:
            raise ValueError(f"source is one of {', '.join(SOURCES)}")
        needed = ("crossref", "datacite") if self.source == "all" else (self.source,)
        for s in needed:
            if s not in self.outputs:
                raise ValueError(f"source {self.source} needs an output for {s}")
        if self.source in ("datacite", "arxiv") and not (self.datacite_records or "datacite" in self.load_index):
            raise ValueError(f"source {self.source} needs registry records or a stored registry index")


def _scan_works(spark: SparkSession, path: str) -> DataFrame:
    """Archives by name, by a glob or in a folder; any other path is a folder of extracted members."""
    archives = path.endswith(".gz") or any(name.endswith(".tar.gz") for name in ([] if "*" in path else names(spark, path)))
    return scan_archives(spark, path) if archives else scan_directory(spark, path)


def _seen(counters: Observation) -> dict[str, int]:
    """What a finished write has counted; nothing where an empty table left nothing to do."""
    try:
        return {k: int(v or 0) for k, v in counters.get.items()}
    except Py4JJavaError:  # Spark has no row of counters then
        return {}


def run_digests(spark: SparkSession, args: PipelineArgs) -> tuple[str, str | None]:
    """What makes a run the same one: its options, and the files of its input while they are there; these are asked for one by one, so of a named run alone."""
    said = [args.input, args.source, args.datacite_records, args.load_index, sorted(args.http_fallback), args.ranges]
    return hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest(), digest(spark, args.input) if args.run_id else None


def write_link_results(links: DataFrame, validated: DataFrame, args: PipelineArgs) -> None:
    """The outputs of a run, from links and one row per cited work, gathered once for all of them; no array of citing works is made for hot ones."""
    arxiv, source = args.source == "arxiv", F.col("matched_source")
    chosen = []
    for s in ("crossref", "datacite") if args.source == "all" else (args.source,):
        good = source == s if args.source == "all" else source.isNotNull()
        chosen += [(only, path) for only, path in ((good, args.outputs.get(s)), (source.isNull(), args.failed.get(s))) if path]
    for _, path in chosen:
        exists(links.sparkSession, path)  # a store that is not there ends a run before anything is gathered for it
    if chosen:
        wanted = reduce(lambda a, b: a | b, [only for only, _ in chosen])
        gathered = gather(links, validated.where(wanted), args.hot)
        for only, path in chosen:
            write_gathered_split(gathered, path, arxiv, only, args.single_file, args.compression)


def invert_ranges(edges: DataFrame, path: str, log: CommitLog, ranges: int, at_once: int, on_commit: Callable[[list[int]], None] | None = None) -> DataFrame:
    """Links of edges that are stored by key_range, written by ranges below path; ranges that log has are not done again.

    What a run that ended had written without committing it is written anew. on_commit is called behind each commit.
    """
    spark = edges.sparkSession
    todo = log.pending(spark.range(ranges).select(F.col("id").cast("int").alias("key")), F.col("key"), "invert")
    left = sorted(r["key"] for r in todo.collect())  # at most as many numbers as there are ranges
    for a in range(0, len(left), at_once):
        now = left[a : a + at_once]
        # A share of a range is one task's, to compare pairs and to write: edges are dealt out once, links not again.
        share = F.pmod(F.xxhash64("citing_doi", "cited_id"), F.lit(SHARES))
        dealt = edges.where(F.col("key_range").isin(now)).withColumn("share", share).repartition("key_range", "share")
        links = dedup_links(dealt, within=("key_range", "share")).drop("share").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        links.partitionBy("key_range").option("compression", "zstd").parquet(path)
        made = read_links(spark, path).where(F.col("key_range").isin(now)).groupBy(F.col("key_range").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        every = spark.createDataFrame([(k,) for k in now], "key int").join(made, "key", "left").fillna(0, "n")
        log.commit("invert", every)
        if on_commit:
            on_commit(now)
    return read_links(spark, path)


def run_pipeline(spark: SparkSession, args: PipelineArgs, resolver: Resolver | None = None, on_commit: Callable[[list[int]], None] | None = None) -> dict:
    """Runs all stages; intermediates go to a folder of this run below temp_dir, removed unless they are kept.

    Works without any match give empty outputs. A run with a run_id goes on where it ended, by phases and, in the
    inversion, by key ranges; under the same run_id, other options or another input are refused. Returns temp and
    stats: what the run's own passes counted, which takes no job besides.
    """
    args.check()
    temp = scratch(spark, args.temp_dir)
    if args.run_id:
        temp = f"{temp.rpartition('/')[0]}/run-{args.run_id}"
    options, files = run_digests(spark, args)
    run = Manifest.load(spark, f"{temp}/manifest") or Manifest(options=options, input=files or "")
    if run.options != options or files and run.input != files:
        raise ValueError(f"run {args.run_id} has other options or another input")
    log = CommitLog(spark, f"{temp}/commits", f"{options}:{run.input}")

    def stage(phase: str, name: str, frame: Callable[[Observation], DataFrame]) -> DataFrame:
        """Written once, with its counters; a run that goes on reads what an earlier one finished."""
        if PHASES.index(run.phase) <= PHASES.index(phase):
            seen = Observation(phase)
            frame(seen).write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).parquet(f"{temp}/{name}")
            run.stats |= _seen(seen)
            run.advance(PHASES[PHASES.index(phase) + 1])
            run.save(spark, f"{temp}/manifest")
        return spark.read.parquet(f"{temp}/{name}")

    item = F.col("item_ord").isNotNull()

    def scanned(seen: Observation) -> DataFrame:
        status = F.col("status")
        # Not dealt out: written as it comes, in row groups that later tasks share, however few archives there are.
        return _scan_works(spark, args.input).observe(
            seen, F.count_if(status == "read").alias("files"), F.count_if(status != "read").alias("rejected"),
            F.count_if(item).alias("items"), F.count_if(item & F.col("doi").isNotNull()).alias("indexed"),
        )

    works = items(stage("extract", "works", scanned))  # an archive is sequential: it is read once
    mode = "arxiv" if args.source == "arxiv" else "doi"
    references = explode_references(works)
    if args.run_id:
        links = _named_links(spark, args, run, references, mode, temp, log, on_commit)
    else:

        def inverted(seen: Observation) -> DataFrame:
            edges = extract_edges(references, mode, counters=seen)
            if args.keep_intermediates:
                write_partitioned_edges(edges, f"{temp}/edges")
                edges = read_partitioned_edges(spark, f"{temp}/edges").drop("pkey")
            return dedup_links(edges)

        links = stage("invert", "links", inverted)
    counts = link_counts(links)
    cited = counts.select("cited_id", (arxiv_doi(F.col("cited_id")) if mode == "arxiv" else F.col("cited_id")).alias("doi"), "reference_count", "citation_count")
    if mode == "arxiv":
        cited = cited.withColumn("arxiv_id", F.col("cited_id"))
    cited.write.mode("overwrite").option("compression", "zstd").parquet(f"{temp}/cited")  # a row a work: counted once, then probed and looked up
    cited = spark.read.parquet(f"{temp}/cited")
    index_a, index_b = _indexes(spark, args, works, cited)

    def validated(seen: Observation) -> DataFrame:
        looked_up = lookup(cited, args.source, index_a, index_b)
        source, found = F.col("matched_source"), [F.count(F.lit(1)).alias("works"), F.sum("citation_count").alias("citations")]
        by_index = [F.count_if(source == s).alias(f"{s}_matched") for s in ("crossref", "datacite")]
        if not (args.source in args.http_fallback or args.source == "all" and args.http_fallback):
            return looked_up.observe(seen, *found, *by_index, F.count_if(source.isNull()).alias("failed"), F.lit(0).alias("resolved"))
        before = looked_up.withColumn("by_index", source)
        resolved = resolve_unmatched(before, resolver or head_status(args.timeout), args.source, args.concurrency, table=args.resolved_table, retries=args.retries)
        by_index = [F.count_if(F.col("by_index") == s).alias(f"{s}_matched") for s in ("crossref", "datacite")]
        newly = F.count_if(F.col("by_index").isNull() & source.isNotNull()).alias("resolved")
        return resolved.observe(seen, *found, *by_index, F.count_if(source.isNull()).alias("failed"), newly).drop("by_index")

    write_link_results(links, stage("validate", "validated", validated), args)
    whole_a = works_index(works) if "crossref" not in args.load_index else read_index(spark, args.load_index["crossref"])
    whole_b = read_index(spark, args.load_index["datacite"]) if "datacite" in args.load_index else read_records(spark, args.datacite_records) if args.datacite_records else None
    for name, index in (("crossref", whole_a), ("datacite", whole_b)):
        if name in args.save_index and index is not None:
            write_index(index, args.save_index[name])
    if not args.keep_intermediates:
        remove(spark, temp)
    return {"temp": temp, "stats": dict.fromkeys(COUNTERS, 0) | run.stats}


#: What a run counts: members and items read, edges, inverted works, and how they were validated.
COUNTERS = (
    "files", "rejected", "items", "indexed", "matches", "refs_with_matches", "works", "citations", "crossref_matched", "datacite_matched", "resolved", "failed",
)


def _indexes(spark: SparkSession, args: PipelineArgs, works: DataFrame, cited: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Indexes to look cited works up in; stored ones are read where cited works can be."""
    a = read_index(spark, args.load_index["crossref"], cited) if "crossref" in args.load_index else works_index(works)
    if "datacite" in args.load_index:
        return a, read_index(spark, args.load_index["datacite"], cited)
    return a, read_records(spark, args.datacite_records) if args.datacite_records else None


def _named_links(
    spark: SparkSession, args: PipelineArgs, run: Manifest, references: DataFrame, mode: str, temp: str, log: CommitLog, on_commit: Callable[[list[int]], None] | None
) -> DataFrame:
    """Links of a run that can go on: edges are stored by key range, then inverted range by range."""
    if PHASES.index(run.phase) <= PHASES.index("invert"):
        if log.finished("edges").isEmpty():
            seen = Observation("edges")
            edges = extract_edges(references, mode, counters=seen).withColumn("key_range", key_range(F.col("cited_id"), args.ranges))
            edges.hint("rebalance", F.col("key_range")).write.mode("overwrite").partitionBy("key_range").option("compression", "zstd").parquet(f"{temp}/edges")
            run.stats |= _seen(seen)
            run.save(spark, f"{temp}/manifest")
            log.commit("edges", spark.createDataFrame([("all", run.stats.get("matches", 0))], "key string, n bigint"))
        edges = spark.read.schema(f"{EDGES}, key_range int").parquet(f"{temp}/edges")
        invert_ranges(edges, f"{temp}/links", log, args.ranges, args.ranges_at_once, on_commit)
        run.advance("validate")
        run.save(spark, f"{temp}/manifest")
    return read_links(spark, f"{temp}/links")


def run_validate(
    spark: SparkSession,
    input: str,
    source: str,
    output_valid: str,
    output_failed: str,
    datacite_records: str | None = None,
    crossref_index: str | None = None,
    http_fallback: bool = False,
    concurrency: int = 50,
    timeout: float = 5.0,
    resolver: Resolver | None = None,
    single_file: bool = False,
    resolved_table: str | None = None,
    retries: int = 0,
    compression: str | None = None,
) -> None:
    """Validates a citations file. Input and outputs must be different paths. A bad record is named by its number.

    compression: of the outputs, a codec that Spark's text writer knows.
    """
    need_a, need_b = source in ("all", "crossref"), source in ("all", "datacite", "arxiv")
    have = (need_a and crossref_index) or (need_b and datacite_records)
    if not (have or http_fallback):
        raise ValueError(f"source {source} needs its index or the HTTP fallback")
    if input in (output_valid, output_failed):
        raise ValueError("input and outputs have to be different paths")
    held = scratch(spark)
    try:
        _validate(spark, held, input, source, output_valid, output_failed, crossref_index if need_a else None, datacite_records if need_b else None,
                  (resolver or head_status(timeout)) if http_fallback else None, concurrency, single_file, resolved_table, retries, compression)
    except (PySparkException, Py4JJavaError) as e:
        bad = first_bad_record(spark, input)  # only a run that failed is read again
        if bad:
            raise ValueError(bad) from e
        raise
    finally:
        remove(spark, held)


def _validate(spark, held, input, source, output_valid, output_failed, crossref_index, datacite_records, resolver, concurrency, single_file, resolved_table, retries, compression) -> None:
    long = [] if source == "arxiv" else files_of_hot(spark, input, HOT)  # read in pieces, as no line of theirs need fit in memory
    if long:
        try:
            heads, entries = read_long_citations(spark, input, long, held)
        except (PySparkException, Py4JJavaError):  # not in the layout after all, or refused: as lines, which tells
            remove(spark, held)
            long = []
    # Stored, not cached: on disk a cache would take what the texts take. Prefixes that are probed come of the column of identifiers.
    with_entry_texts(read_citations(spark, input, long)).write.option("compression", "zstd").parquet(f"{held}/records")
    records = spark.read.parquet(f"{held}/records")
    probes = records.select("doi")
    if long:
        probes = probes.unionByName(heads.select("doi"))
    a = read_index(spark, crossref_index, probes) if crossref_index else None
    b = read_records(spark, datacite_records) if datacite_records else None

    def found(citations: DataFrame) -> DataFrame:
        looked_up = lookup(citations, source, a, b)
        if resolver:
            return resolve_unmatched(looked_up, resolver, source, concurrency, table=resolved_table, retries=retries)
        return looked_up

    found(records).write.option("compression", "zstd").parquet(f"{held}/looked_up")
    remove(spark, f"{held}/records")
    looked_up = spark.read.parquet(f"{held}/looked_up")
    good, bad = F.col("matched_source").isNotNull(), F.col("matched_source").isNull()
    for chosen, path in ((good, output_valid), (bad, output_failed)):
        write_split(looked_up.where(chosen).drop("matched_source"), path, source == "arxiv", single_file, compression)
    if long:
        found(heads).write.option("compression", "zstd").parquet(f"{held}/validated")
        heads = spark.read.parquet(f"{held}/validated")
        for chosen, path in ((good, output_valid), (bad, output_failed)):
            some = heads.where(chosen)
            append_long_split(some, entries.join(some.select("line"), "line", "left_semi"), path, compression)
