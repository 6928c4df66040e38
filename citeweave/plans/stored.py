"""Queries that write derived data by the sinks, read it back by the sources, and the SQL that gives the same rows."""

from __future__ import annotations

import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave import fixtures
from citeweave.functions.arxiv import arxiv_doi
from citeweave.functions.elapsed import elapsed as elapsed_of
from citeweave.functions.keys import partition_key
from citeweave.functions.tables import register
from citeweave.operators.extract import explode_references, extract_edges, search_text
from citeweave.operators.invert import citation_counts, dedup_links, invert, link_counts
from citeweave.operators.resolve import ANSWERS, resolve_unmatched
from citeweave.operators.validate import lookup
from citeweave.plans.pipeline import PipelineArgs, run_pipeline, run_validate, write_link_results
from citeweave.schemas import REFS
from citeweave.scratch import scratch
from citeweave.sinks.lines import gather, write_gathered, write_lines, write_lines_split
from citeweave.sinks.outputs import compact_edges, split_path, split_path_of, write_inverted_links, write_partitioned_edges
from citeweave.sources.edges import read_partitioned_edges, read_ranked
from citeweave.sources.records import bad_records, read_citations, read_entries, read_heads, read_index, read_prefixes, read_records, write_index
from citeweave.sources.works import members, read_archive, read_directory, scan_archives, works_index
from citeweave.storage import remove
from citeweave.streaming.commits import CommitLog
from citeweave.streaming.incremental import read_links, stream_links
from citeweave.streaming.manifest import PHASES, Manifest, pending_edges

#: Works of one JSON document, and documents of one archive, of the derived corpus.
WORKS_PER_MEMBER, MEMBERS_PER_ARCHIVE = 500, 16


def _edges(spark: SparkSession, d: str, mode: str = "doi") -> DataFrame:
    """Edges whose references are JSON, but for those of kind 3."""
    refs = fixtures.references(spark, d)
    text = F.when(F.col("kind") != 3, F.to_json(F.struct(F.col("kind").alias("kind")))).otherwise("no JSON {")
    return extract_edges(refs.withColumn("ref_json", text), mode)


def _paired(spark: SparkSession, d: str, mode: str = "doi") -> DataFrame:
    return fixtures.by_pair(spark, d, _edges(spark, d, mode))


def _citations(spark: SparkSession, d: str, mode: str = "doi") -> DataFrame:
    inverted = invert(_paired(spark, d, mode), mode)
    return inverted.withColumn("doi", F.col("arxiv_doi" if mode == "arxiv" else "cited_id"))


def _members(spark: SparkSession, d: str) -> DataFrame:
    """(member, items): the references as works in JSON documents. Every seventh work has no DOI, every fifth reference no text."""
    refs = fixtures.references(spark, d)
    named = {"DOI": "doi_field", "URL": "url", "article-title": "article_title", "journal-title": "journal_title", "unstructured": "unstructured"}
    spoken = (F.col("item_ord") + F.col("ref_index")) % 5 != 0
    reference = F.struct(*[F.when(spoken, F.col(c)).alias(k) for k, c in named.items()], F.col("asserted_by").alias("doi-asserted-by"))
    of_work = refs.groupBy("item_ord", "citing_doi").agg(F.array_sort(F.collect_list(F.struct("ref_index", reference.alias("r")))).alias("refs"))
    item = F.struct(F.when(F.col("item_ord") % 7 != 0, F.upper("citing_doi")).alias("DOI"), F.transform("refs", lambda x: x.r).alias("reference"))
    of_member = of_work.groupBy(F.floor(F.col("item_ord") / WORKS_PER_MEMBER).alias("member")).agg(F.array_sort(F.collect_list(F.struct("item_ord", item.alias("item")))).alias("items"))
    return of_member.select("member", F.transform("items", lambda x: x.item).alias("items"))


def _folder(spark: SparkSession, d: str) -> str:
    """Extracted members: one JSON document a file."""
    path = scratch(spark)
    _members(spark, d).select("items", F.format_string("%08d", "member").alias("member")).write.partitionBy("member").json(path)
    return path



def _tar_members(names: pd.Series, texts: pd.Series) -> pd.Series:
    """Header and content of each member, all but its last line end; blanks fill it up to whole blocks."""

    def one(name: str, text: str) -> str:
        size = -(-(len(text.encode()) + 1) // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE
        info = tarfile.TarInfo(name)
        info.size = size
        return info.tobuf(tarfile.USTAR_FORMAT).decode() + text + " " * (size - 1 - len(text.encode()))

    return pd.Series([one(n, t) for n, t in zip(names, texts)])


def _archives(spark: SparkSession, d: str) -> str:
    """The same as tar.gz files, an archive a folder, with members that are no JSON beside them. Spark's own text writer makes them, in any store."""
    path = scratch(spark)
    archive = F.floor(F.col("member") / MEMBERS_PER_ARCHIVE)
    texts = _members(spark, d).select(archive.alias("archive"), F.format_string("%08d.json", "member").alias("name"), F.to_json(F.struct("items")).alias("text"))
    others = [("broken.json", "{"), ("other.JSON", '{"items": [{"DOI": "10.1/x"}]}')]
    beside = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in others])
    every = texts.unionByName(texts.select("archive").distinct().select("archive", F.inline(beside)))
    ends = texts.select("archive").distinct().select("archive", F.lit("~").alias("name"), F.repeat(F.lit("\0"), 2 * tarfile.BLOCKSIZE).alias("value"))
    rows = every.select("archive", "name", F.pandas_udf(_tar_members, "string")("name", "text").alias("value")).unionByName(ends)
    rows.repartition("archive").sortWithinPartitions("archive", "name").select("archive", "value").write.partitionBy("archive").option("compression", "gzip").text(path)
    return path


def _counted(works: DataFrame) -> DataFrame:
    return works.select(F.lower("doi").alias("doi"), F.size("refs").cast("bigint").alias("n_refs"))


def works_folder(spark, d):
    return _counted(read_directory(spark, _folder(spark, d)))


def works_archive(spark, d):
    return _counted(read_archive(spark, _archives(spark, d)))


def works_dois(spark, d):
    return works_index(read_directory(spark, _folder(spark, d)))


def works_references(spark, d):
    return explode_references(read_directory(spark, _folder(spark, d))).select("citing_doi", "ref_index", search_text().alias("text"), "asserted_by")


def skip_rules(spark, d):
    return extract_edges(explode_references(read_directory(spark, _folder(spark, d)))).select("citing_doi", "ref_index", "raw_match", "cited_id", "provenance")


def records_scan(spark, d):
    path = scratch(spark)
    lines = fixtures.index_b(spark, d).select(F.to_json(F.struct(F.upper("doi").alias("id"))).alias("value"))
    bad = spark.createDataFrame([("",), ("{",), ('{"id": 5}',), ('{"name": "10.1/x"}',), ("   ",)], "value string")
    lines.union(bad).write.option("compression", "gzip").text(path)
    return read_records(spark, path)


def index_scan(spark, d):
    path = scratch(spark)
    write_index(fixtures.index_b(spark, d), path)
    return read_index(spark, path)


def index_prefix_file(spark, d):
    path = scratch(spark)
    write_index(fixtures.index_b(spark, d), path)
    return spark.read.parquet(f"{path}.prefixes")


def citations_scan(spark, d):
    """Entries have a field that this engine does not know; it comes through."""
    path = scratch(spark)
    entry = F.transform("cited_by", lambda c: F.struct(c.doi.alias("doi"), c.provenance.alias("provenance"), F.length(c.doi).alias("note")))
    _citations(spark, d).select(F.to_json(F.struct("doi", "reference_count", "citation_count", entry.alias("cited_by"))).alias("value")).write.text(path)
    read = read_citations(spark, path).select("doi", "citation_count", F.explode("cited_by").alias("c"))
    field = lambda name, kind: F.try_variant_get("c", f"$.{name}", kind)
    return read.select("doi", "citation_count", field("doi", "string").alias("citing_doi"), field("provenance", "string").alias("provenance"), field("note", "bigint").alias("note"))


def _links(spark: SparkSession, d: str, mode: str = "doi") -> tuple[DataFrame, DataFrame]:
    """Links, stored as a run stores them, and a row for each cited work."""
    path = scratch(spark)
    dedup_links(_paired(spark, d, mode)).write.option("compression", "zstd").parquet(path)
    links = spark.read.parquet(path)
    works = link_counts(links).withColumn("doi", arxiv_doi(F.col("cited_id")) if mode == "arxiv" else F.col("cited_id"))
    return links, works


def generic_jsonl(spark, d):
    path = scratch(spark)
    write_gathered(gather(*_links(spark, d)), path, compression="gzip")
    return read_heads(spark, path, ["doi", "reference_count", "citation_count"])


def arxiv_jsonl(spark, d):
    path = scratch(spark)
    write_gathered(gather(*_links(spark, d, "arxiv")), path, arxiv=True, compression="gzip")
    return read_heads(spark, path, ["arxiv_doi", "arxiv_id", "reference_count", "citation_count"])


ENTRY = "doi string, provenance string, matches array<struct<raw_match string, reference variant>>"


def cited_by_entries(spark, d):
    path = scratch(spark)
    write_gathered(gather(*_links(spark, d)), path)
    read = read_entries(spark, path).select(F.col("work").alias("cited_id"), F.from_json("entry", ENTRY).alias("c"))
    match = F.col("c.matches")[0]
    kind = F.try_variant_get(match.reference, "$.kind", "bigint")
    return read.select("cited_id", F.col("c.doi").alias("citing_doi"), F.col("c.provenance").alias("provenance"), match.raw_match.alias("raw_match"), kind.alias("kind"))


def split_paths(spark, d):
    """Paths with one, several and no endings, in folders with and without dots."""
    ending = F.when(F.col("p_partkey") % 4 == 0, ".jsonl").when(F.col("p_partkey") % 4 == 1, "").when(F.col("p_partkey") % 4 == 2, ".x.gz").otherwise(F.concat(F.lit("."), F.translate("p_brand", "#", "")))
    path = F.concat(F.lit("out."), F.col("p_size").cast("string"), F.lit("/"), F.translate("p_name", " ", "_"), ending)
    found = spark.read.parquet(f"{d}/part.parquet").select(path.alias("path")).distinct()
    return found.select("path", split_path_of(F.col("path"), "asserted").alias("asserted"), split_path_of(F.col("path"), "mined").alias("mined"))


def _split(spark, d, mode, kind):
    path = f"{scratch(spark)}/out.jsonl"
    write_lines_split(*_links(spark, d, mode), path, mode == "arxiv", compression="gzip")
    return read_heads(spark, split_path(path, kind), (["arxiv_doi", "arxiv_id"] if mode == "arxiv" else ["doi"]) + ["reference_count", "citation_count"])


def source_outputs(spark, d):
    base = scratch(spark)
    links, works = _links(spark, d)
    lookup(works, "all", fixtures.index_a(spark, d), fixtures.index_b(spark, d)).write.option("compression", "zstd").parquet(f"{base}/validated")
    outputs = {s: f"{base}/{s}.jsonl" for s in ("crossref", "datacite")}
    failed = {s: f"{base}/{s}_failed.jsonl" for s in outputs}
    write_link_results(links, spark.read.parquet(f"{base}/validated"), PipelineArgs("", outputs=outputs, failed=failed, compression="gzip"))
    made = {**outputs, **{f"{s}_failed": p for s, p in failed.items()}}
    parts = [read_heads(spark, p, ["doi", "citation_count"]).withColumn("output", F.lit(k)) for k, p in made.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def edges_by_key(spark, d):
    path = scratch(spark)
    write_partitioned_edges(_edges(spark, d), path)
    return read_partitioned_edges(spark, path).where("pkey = '10.5061'").select("pkey", "citing_doi", "cited_id", "match_ord")


def edges_appended(spark, d):
    """Edges of odd and even references in two writes, read as one table."""
    path, edges = scratch(spark), _edges(spark, d)
    write_partitioned_edges(edges.where("ref_index % 2 = 0"), path)
    write_partitioned_edges(edges.where("ref_index % 2 = 1"), path, "append")
    return read_partitioned_edges(spark, path).groupBy("pkey").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("cited_id").alias("n_cited"))


def edges_union(spark, d):
    both = _edges(spark, d).unionByName(_edges(spark, d, "arxiv"))
    return both.groupBy("cited_id").agg(F.count(F.lit(1)).alias("n_edges"))


def inverted_parquet(spark, d):
    path, (links, _) = scratch(spark), _links(spark, d)
    write_inverted_links(links, path)
    rows = spark.read.parquet(path).withColumn("n", F.size("cited_by").cast("bigint"))
    # Works of one row as they are; only rows of works in parts are added up.
    one = rows.where("parts = 1").select("cited_id", "citation_count", "reference_count", F.col("n").alias("n_entries"))
    return one.unionByName(rows.where("parts > 1").groupBy("cited_id", "citation_count", "reference_count").agg(F.sum("n").alias("n_entries")))


def skip_inverted(spark, d):
    """What is left to invert for a run that has done the keys of works 10.1000 to 10.1019."""
    run = Manifest(partitions_inverted=[f"10.{k}" for k in range(1000, 1020)])
    return citation_counts(pending_edges(_edges(spark, d), run)).select("cited_id", "citation_count")


def resolver_union(spark, d):
    looked_up = lookup(citation_counts(_edges(spark, d)), "all", fixtures.index_a(spark, d), fixtures.index_b(spark, d), "cited_id")
    found = resolve_unmatched(looked_up, lambda doi: doi[-1] in "02468", "all", column="cited_id")
    return found.select("cited_id", "citation_count", "matched_source")


def elapsed(spark, d):
    ms = F.col("o_orderkey") * 977
    return spark.read.parquet(f"{d}/orders.parquet").select(ms.alias("ms")).distinct().select("ms", elapsed_of(F.col("ms")).alias("shown"))


def manifest_json(spark, d):
    """The keys of all edges, kept in a commit log of JSON and loaded again; none passes through the driver."""
    log = CommitLog(spark, scratch(spark), "this run")
    log.commit("written", _edges(spark, d).groupBy(partition_key(F.col("cited_id")).alias("key")).agg(F.count(F.lit(1)).alias("n")))
    CommitLog(spark, log.path, "another run").commit("written", spark.createDataFrame([("10.0", 1)], "key string, n bigint"))
    return log.finished("written").select(F.col("key").alias("pkey"))


def archive_members(spark, d):
    """What became of the members of each archive; the one that is no JSON is named, one of another ending is not read."""
    found = members(scan_archives(spark, _archives(spark, d)))
    name, archive = F.substring_index("entry_path", "!", -1), F.regexp_extract("entry_path", "archive=([0-9]+)", 1).cast("bigint")
    return found.select(archive.alias("archive"), name.alias("member"), F.substring_index("status", ":", 1).alias("status"))


COUNTERS = ("files", "rejected", "items", "indexed", "matches", "refs_with_matches", "works", "citations", "crossref_matched", "failed")


def run_counters(spark, d):
    """What a run's own passes count, archives to validated works."""
    base = scratch(spark)
    stats = run_pipeline(spark, PipelineArgs(f"{_archives(spark, d)}/*/*.gz", "crossref", outputs={"crossref": f"{base}/o.jsonl"}, temp_dir=base, compression="gzip"))["stats"]
    return spark.createDataFrame([[stats[k] for k in COUNTERS]], ", ".join(f"{k} bigint" for k in COUNTERS))


def resumed_ranges(spark, d):
    """A run that ended behind half of its key ranges goes on with the rest, without its input."""
    base = scratch(spark)
    args = PipelineArgs(_folder(spark, d), "crossref", outputs={"crossref": f"{base}/o.jsonl"}, temp_dir=base, compression="gzip", run_id="again", ranges=8, ranges_at_once=2, keep_intermediates=True)
    done = []

    def ends(now):
        done.extend(now)
        if len(done) == 4:
            raise InterruptedError

    try:
        run_pipeline(spark, args, on_commit=ends)
    except InterruptedError:
        remove(spark, args.input)
    run_pipeline(spark, args, on_commit=done.extend)
    n = spark.read.json(f"{base}/run-again/commits").where("phase = 'invert'").agg(F.count(F.lit(1)).alias("n_commits"), F.sum("n").alias("n_links")).first().asDict()
    figures = {k: F.lit(v).cast("bigint") for k, v in {**n, "n_ranges_run": len(done)}.items()}
    return read_heads(spark, f"{base}/o.jsonl", ["doi", "citation_count"]).withColumns(figures)


#: Places of which join_texts makes one text first.
RUN = 4096


def join_texts(rows: DataFrame, key: str, split: str, at: str, text: str, by: str) -> DataFrame:
    """(key, joined): texts of a key in the order of their splits and places, joined by by.

    Runs of at most RUN places are joined first, so that a key's array is one of runs: of millions of texts it would not
    fit in a task beside their join.
    """
    ordered = lambda *place: F.array_join(F.array_sort(F.collect_list(F.struct(*place, "t"))).getField("t"), by)
    placed = rows.select(key, F.col(split).alias("split"), F.col(at).alias("at"), F.col(text).alias("t"))
    runs = placed.groupBy(key, "split", F.floor(F.col("at") / RUN).alias("run")).agg(ordered("at").alias("t"))
    return runs.groupBy(key).agg(ordered("split", "run").alias("joined"))


def hot_lines(spark, d):
    """Lines of works with more than twenty citing ones are put together by the writer, the others gathered."""
    path, (links, works) = scratch(spark), _links(spark, d)
    write_lines(links, works, path, hot=20, compression="gzip")
    heads = read_heads(spark, path, ["doi", "reference_count", "citation_count"])
    counts = heads.select(F.col("doi").alias("work"), *[F.col(c).cast("bigint") for c in ("reference_count", "citation_count")])
    shown = lambda c: F.concat_ws("|", c.doi, c.provenance, c.matches[0].raw_match, F.try_variant_get(c.matches[0].reference, "$.kind", "string"))
    entries = read_entries(spark, path).select("work", "nth", F.from_json("entry", ENTRY).alias("c")).select("work", "nth", shown(F.col("c")).alias("shown"))
    return counts.join(join_texts(entries, "work", "nth.split", "nth.at", "shown", ";"), "work").select(F.col("work").alias("doi"), "reference_count", "citation_count", F.col("joined").alias("cited_by"))


def record_numbers(spark, d):
    """Citation files, one a prefix, with blank lines of all kinds and records that are refused: their numbers."""
    path = scratch(spark)
    counts = citation_counts(_edges(spark, d)).select("cited_id", "citation_count", partition_key(F.col("cited_id")).alias("pkey"), (F.ascii(F.substring("cited_id", -1, 1)) * 31 + F.length("cited_id") * 7 + F.col("citation_count")).alias("c"))
    whole = F.to_json(F.struct(F.col("cited_id").alias("doi"), F.lit(1).alias("reference_count"), "citation_count", F.array().cast("array<string>").alias("cited_by")))
    line = F.when(F.col("c") % 11 == 0, F.substring(whole, 1, 9)).when(F.col("c") % 13 == 0, F.to_json(F.struct(F.col("cited_id").alias("doi")))).otherwise(whole)
    blank = F.when(F.col("c") % 5 == 0, F.array(F.lit(" \t\u00a0"), F.lit(""), line)).otherwise(F.array(line))
    rows = counts.repartition("pkey").sortWithinPartitions("pkey", "cited_id").select("pkey", F.explode(blank).alias("value"))
    rows.write.partitionBy("pkey").text(path)
    return bad_records(spark, path).select(F.regexp_extract("file", "pkey=([^/]+)", 1).alias("pkey"), "number", "reason")


def ranked_parquet(spark, d):
    """The rank of a work is its place in the files."""
    path, (links, _) = scratch(spark), _links(spark, d)
    write_inverted_links(links, path)
    return read_ranked(spark, path).select("rank", "cited_id", "citation_count")


def index_pruned(spark, d):
    """Cited works of one registrant, looked up in what a stored index holds near them."""
    path = scratch(spark)
    write_index(fixtures.index_a(spark, d).union(fixtures.index_b(spark, d)), path)
    cited = citation_counts(_edges(spark, d)).where("cited_id LIKE '10.1007/%'").select(F.col("cited_id").alias("doi"))
    return cited.join(read_index(spark, path, cited), "doi", "left_semi")


def index_prefixes_read(spark, d):
    path = scratch(spark)
    write_index(fixtures.index_b(spark, d), path)
    return read_prefixes(spark, path)


def edges_compacted(spark, d):
    """Four appends of a skewed table, rewritten: a file a key."""
    path, target, edges = scratch(spark), scratch(spark), _edges(spark, d)
    for k in range(4):
        write_partitioned_edges(edges.where(F.col("ref_index") % 4 == k), path, "append")
    compact_edges(spark, path, target)
    kept = read_partitioned_edges(spark, target).select("pkey", F.col("_metadata.file_name").alias("file"))
    return kept.groupBy("pkey").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("file").alias("n_files"))


def resolver_table(spark, d):
    """Answers for what no index has; a second run asks nothing."""
    table = scratch(spark)
    looked_up = lookup(citation_counts(_edges(spark, d)), "all", fixtures.index_a(spark, d), fixtures.index_b(spark, d), "cited_id")
    resolve_unmatched(looked_up, lambda doi: 302 if doi[-1] in "02468" else 404, "all", column="cited_id", table=table)

    def never(doi):
        raise AssertionError(doi)

    found = resolve_unmatched(looked_up, never, "all", column="cited_id", table=table).select(F.col("cited_id").alias("doi"), "matched_source")
    return spark.read.schema(ANSWERS).parquet(table).select("doi", "outcome", "detail").join(found, "doi")


def pipeline_outputs(spark, d):
    base = scratch(spark)
    args = PipelineArgs(_folder(spark, d), "crossref", outputs={"crossref": f"{base}/o.jsonl"}, failed={"crossref": f"{base}/f.jsonl"}, temp_dir=base, compression="gzip")
    run_pipeline(spark, args)
    good, bad = (read_heads(spark, f"{base}/{x}.jsonl", ["doi", "citation_count"]) for x in "of")
    return good.withColumn("valid", F.lit(True)).union(bad.withColumn("valid", F.lit(False)))


def resumed_phases(spark, d):
    """A run that ended before its outputs were written goes on without its input."""
    base = scratch(spark)
    args = PipelineArgs(_folder(spark, d), "crossref", outputs={"crossref": "no-such-store://o.jsonl"}, temp_dir=base, compression="gzip", run_id="again", ranges=4, keep_intermediates=True)
    try:
        run_pipeline(spark, args)
    except Exception:  # the store of its output is missing
        remove(spark, args.input)
    args.outputs = {"crossref": f"{base}/o.jsonl"}
    run_pipeline(spark, args)
    phase = Manifest.load(spark, f"{base}/run-again/manifest").phase
    return read_heads(spark, f"{base}/o.jsonl", ["doi", "citation_count"]).withColumn("phase", F.lit(phase)).withColumn("n_phases", F.lit(len(PHASES)))


def validated_file(spark, d):
    base = scratch(spark)
    write_gathered(gather(*_links(spark, d)), f"{base}/in", compression="gzip")
    write_index(fixtures.index_a(spark, d), f"{base}/index")
    run_validate(spark, f"{base}/in", "crossref", f"{base}/v.jsonl", f"{base}/f.jsonl", crossref_index=f"{base}/index", compression="gzip")
    good, bad = (read_heads(spark, f"{base}/{x}.jsonl", ["doi", "citation_count"]) for x in "vf")
    return good.withColumn("valid", F.lit(True)).union(bad.withColumn("valid", F.lit(False)))


def self_links(spark, d):
    """Works that cite themselves: in the same spelling they go, in another one they stay, as identifiers are compared as they are here."""
    works = fixtures.references(spark, d).select("citing_doi", "entry_ord", "item_ord").distinct()
    spelled = F.when(F.col("item_ord") % 3 == 0, F.col("citing_doi")).when(F.col("item_ord") % 3 == 1, F.upper("citing_doi")).otherwise(F.reverse("citing_doi"))
    named = {"cited_id": spelled, "raw_match": spelled, "ref_json": F.lit("{}"), "provenance": F.lit("mined"), "ref_index": F.lit(0).cast("bigint"), "match_ord": F.lit(0).cast("bigint")}
    return dedup_links(works.withColumns(named)).select("citing_doi", "cited_id")


def extract_table_function(spark, d):
    """The SQL table function in lateral joins, in both modes."""
    register(spark)
    refs = fixtures.references(spark, d).withColumn("text", search_text()).withColumn("mode", F.explode(F.array(F.lit("doi"), F.lit("arxiv"))))
    select = "SELECT citing_doi, item_ord, ref_index, mode, match_ord, raw_match, identifier FROM {refs}, LATERAL extract_identifiers(text, mode)"
    return spark.sql(select, refs=refs)


def incremental_links(spark, d):
    """References in three arrivals, the third of which repeats a part of the first, equal one batch."""
    source, path, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    refs = fixtures.references(spark, d).select(*[f.split()[0] for f in REFS.split(", ")])
    for some in (F.col("ref_index") % 2 == 0, F.col("ref_index") % 2 == 1, F.col("ref_index") == 0):
        refs.where(some).write.mode("append").option("compression", "zstd").parquet(source)
        stream_links(spark, source, path, checkpoint, ranges=8).awaitTermination()
    return read_links(spark, path).select("citing_doi", "cited_id", "raw_match", "provenance", "ref_index")


def queries() -> dict:
    plain = (
        works_folder, works_archive, works_dois, works_references, skip_rules, records_scan, index_scan, index_prefix_file, citations_scan,
        generic_jsonl, arxiv_jsonl, cited_by_entries, split_paths, source_outputs, edges_by_key, edges_appended, edges_union,
        inverted_parquet, skip_inverted, resolver_union, elapsed, manifest_json, pipeline_outputs, resumed_phases, validated_file,
        archive_members, run_counters, resumed_ranges, hot_lines, record_numbers, ranked_parquet, index_pruned, index_prefixes_read, edges_compacted, resolver_table,
        self_links, extract_table_function, incremental_links,
    )
    split = {f"{mode}_{kind}_jsonl": (lambda s, d, mode=mode, kind=kind: _split(s, d, mode, kind)) for mode in ("doi", "arxiv") for kind in ("asserted", "mined")}
    return {f.__name__: f for f in plain} | split


def oracle_selects(pkey: str, prefix: str) -> dict[str, str]:
    """Behind the common tables of the catalogue. e2, c2: edges and counts of the works as the members have them."""
    count = "CAST(count(*) AS VARCHAR)"
    in_jsonl = "SELECT {} count(*)::VARCHAR AS reference_count, count(*)::VARCHAR AS citation_count FROM {} WHERE citing_doi <> cited_id GROUP BY cited_id"
    split = "SELECT {} CAST(count(*) AS VARCHAR) AS reference_count, CAST(count(*) FILTER (WHERE {}) AS VARCHAR) AS citation_count FROM {} WHERE citing_doi <> cited_id GROUP BY cited_id HAVING count(*) FILTER (WHERE {}) > 0"
    of = {"asserted": "provenance <> 'mined'", "mined": "provenance = 'mined'"}
    arxiv = "concat('10.48550/arXiv.', cited_id) AS arxiv_doi, cited_id AS arxiv_id,"
    spoken = "(item_ord + ref_index) % 5 <> 0"
    edge2 = f"SELECT * FROM e WHERE {spoken} AND item_ord % 7 <> 0"
    count2 = f"SELECT cited_id, count(DISTINCT citing_doi) AS n FROM ({edge2}) GROUP BY 1"
    known2 = "cited_id IN (SELECT lower(citing_doi) FROM refs WHERE item_ord % 7 <> 0)"
    even = "right(cited_id, 1) IN ('0', '2', '4', '6', '8')"
    stem = "regexp_extract(path, '^(.*?)(\\.[^./]*)?$', {})"
    sided = "SELECT cited_id AS doi, CAST(citation_count AS VARCHAR) AS citation_count, '{}' AS output FROM cs WHERE matched_source {}"
    return {
        "works_folder": "SELECT CASE WHEN item_ord % 7 <> 0 THEN lower(any_value(citing_doi)) END AS doi, count(*) AS n_refs FROM refs GROUP BY item_ord",
        "works_archive": "SELECT CASE WHEN item_ord % 7 <> 0 THEN lower(any_value(citing_doi)) END AS doi, count(*) AS n_refs FROM refs GROUP BY item_ord",
        "works_dois": "SELECT DISTINCT lower(citing_doi) AS doi FROM refs WHERE item_ord % 7 <> 0",
        "works_references": f"SELECT lower(citing_doi) AS citing_doi, ref_index, CASE WHEN {spoken} THEN text ELSE '' END AS text, asserted_by FROM rt WHERE item_ord % 7 <> 0",
        "skip_rules": f"SELECT citing_doi, ref_index, raw_match, cited_id, provenance FROM ({edge2})",
        "records_scan": "SELECT doi FROM idx_b",
        "index_scan": "SELECT doi FROM idx_b",
        "index_prefix_file": f"SELECT DISTINCT {prefix.format('doi')} AS prefix FROM idx_b WHERE doi LIKE '10.%/%'",
        "citations_scan": "SELECT u.cited_id AS doi, c.citation_count, citing_doi, provenance, CAST(length(citing_doi) AS BIGINT) AS note FROM u JOIN c ON c.cited_id = u.cited_id WHERE citing_doi <> u.cited_id",
        "generic_jsonl": in_jsonl.format("cited_id AS doi,", "u"),
        "arxiv_jsonl": in_jsonl.format(arxiv, "ua"),
        "cited_by_entries": "SELECT u.cited_id, u.citing_doi, u.provenance, raw_match, CASE WHEN kind <> 3 THEN CAST(kind AS BIGINT) END AS kind FROM u JOIN refs USING (item_ord, ref_index) WHERE u.citing_doi <> u.cited_id",
        "split_paths": f"""SELECT path, {stem.format(1)} || '_asserted' || {stem.format(2)} AS asserted, {stem.format(1)} || '_mined' || {stem.format(2)} AS mined
            FROM (SELECT DISTINCT 'out.' || p_size || '/' || replace(p_name, ' ', '_') || CASE p_partkey % 4 WHEN 0 THEN '.jsonl' WHEN 1 THEN '' WHEN 2 THEN '.x.gz' ELSE '.' || replace(p_brand, '#', '') END AS path FROM part)""",
        "source_outputs": " UNION ALL ".join([sided.format("crossref", "= 'crossref'"), sided.format("datacite", "= 'datacite'"), sided.format("crossref_failed", "IS NULL"), sided.format("datacite_failed", "IS NULL")]),
        "edges_by_key": f"SELECT {pkey} AS pkey, citing_doi, cited_id, match_ord FROM e WHERE {pkey} = '10.5061'",
        "edges_appended": f"SELECT {pkey} AS pkey, count(*) AS n_edges, count(DISTINCT cited_id) AS n_cited FROM e GROUP BY 1",
        "edges_union": "SELECT cited_id, count(*) AS n_edges FROM (SELECT cited_id FROM e UNION ALL SELECT cited_id FROM ea) GROUP BY 1",
        "inverted_parquet": "SELECT cited_id, citation_count, reference_count, citation_count AS n_entries FROM c",
        "skip_inverted": f"SELECT cited_id, citation_count FROM c WHERE NOT ({pkey} >= '10.1000' AND {pkey} < '10.1020' AND length({pkey}) = 7)",
        "resolver_union": "SELECT cited_id, citation_count, coalesce(matched_source, CASE WHEN right(cited_id, 1) IN ('0', '2', '4', '6', '8') THEN 'datacite' END) AS matched_source FROM cs",
        "elapsed": "SELECT ms, CASE WHEN ms >= 3600000 THEN printf('%dh %dm %ds', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60) WHEN ms >= 60000 THEN printf('%dm %ds', ms // 60000, ms // 1000 % 60) ELSE printf('%d.%03ds', ms // 1000, ms % 1000) END AS shown FROM (SELECT DISTINCT CAST(o_orderkey AS BIGINT) * 977 AS ms FROM orders)",
        "manifest_json": f"SELECT DISTINCT {pkey} AS pkey FROM e",
        "pipeline_outputs": f"SELECT cited_id AS doi, CAST(n AS VARCHAR) AS citation_count, cited_id IN (SELECT lower(citing_doi) FROM refs WHERE item_ord % 7 <> 0) AS valid FROM ({count2})",
        "resumed_phases": f"SELECT cited_id AS doi, CAST(n AS VARCHAR) AS citation_count, 'complete' AS phase, 4 AS n_phases FROM ({count2}) WHERE cited_id IN (SELECT lower(citing_doi) FROM refs WHERE item_ord % 7 <> 0)",
        "validated_file": "SELECT cited_id AS doi, CAST(citation_count AS VARCHAR) AS citation_count, cited_id IN (SELECT doi FROM idx_a) AS valid FROM c",
        "archive_members": f"""SELECT DISTINCT item_ord // {WORKS_PER_MEMBER * MEMBERS_PER_ARCHIVE} AS archive, printf('%08d.json', item_ord // {WORKS_PER_MEMBER}) AS member, 'read' AS status FROM refs
            UNION ALL SELECT DISTINCT item_ord // {WORKS_PER_MEMBER * MEMBERS_PER_ARCHIVE}, 'broken.json', 'malformed' FROM refs""",
        "run_counters": f"""SELECT (SELECT count(DISTINCT item_ord // {WORKS_PER_MEMBER}) FROM refs) AS files, (SELECT count(DISTINCT item_ord // {WORKS_PER_MEMBER * MEMBERS_PER_ARCHIVE}) FROM refs) AS rejected,
            (SELECT count(DISTINCT item_ord) FROM refs) AS items, (SELECT count(DISTINCT item_ord) FROM refs WHERE item_ord % 7 <> 0) AS indexed,
            (SELECT count(*) FROM ({edge2})) AS matches, (SELECT count(*) FROM (SELECT DISTINCT item_ord, ref_index FROM ({edge2}))) AS refs_with_matches,
            count(*) AS works, CAST(sum(n) AS BIGINT) AS citations, count(*) FILTER (WHERE {known2}) AS crossref_matched, count(*) FILTER (WHERE NOT {known2}) AS failed FROM ({count2})""",
        "resumed_ranges": f"""SELECT cited_id AS doi, CAST(n AS VARCHAR) AS citation_count, CAST(8 AS BIGINT) AS n_commits, CAST((SELECT sum(n) FROM ({count2})) AS BIGINT) AS n_links, CAST(8 AS BIGINT) AS n_ranges_run
            FROM ({count2}) WHERE {known2}""",
        "hot_lines": """SELECT u.cited_id AS doi, count(*) AS reference_count, count(*) AS citation_count,
            string_agg(concat_ws('|', u.citing_doi, u.provenance, raw_match, CASE WHEN kind <> 3 THEN CAST(kind AS VARCHAR) END), ';' ORDER BY encode(u.citing_doi)) AS cited_by
            FROM u JOIN refs USING (item_ord, ref_index) WHERE u.citing_doi <> u.cited_id GROUP BY 1""",
        "record_numbers": f"""SELECT pkey, number, CASE WHEN code % 11 = 0 THEN 'malformed' ELSE 'lacks a required field' END AS reason
            FROM (SELECT {pkey} AS pkey, row_number() OVER (PARTITION BY {pkey} ORDER BY encode(cited_id)) AS number, ascii(right(cited_id, 1)) * 31 + length(cited_id) * 7 + citation_count AS code FROM c) WHERE code % 11 = 0 OR code % 13 = 0""",
        "ranked_parquet": "SELECT row_number() OVER (ORDER BY citation_count DESC, encode(cited_id)) AS rank, cited_id, citation_count FROM c",
        "index_pruned": "SELECT cited_id AS doi FROM c WHERE cited_id LIKE '10.1007/%' AND cited_id IN (SELECT doi FROM m)",
        "index_prefixes_read": f"SELECT DISTINCT {prefix.format('doi')} AS prefix FROM idx_b WHERE doi LIKE '10.%/%'",
        "edges_compacted": f"SELECT {pkey} AS pkey, count(*) AS n_edges, CAST(1 AS BIGINT) AS n_files FROM e GROUP BY 1",
        "self_links": """SELECT * FROM (SELECT DISTINCT citing_doi, CASE item_ord % 3 WHEN 0 THEN citing_doi WHEN 1 THEN upper(citing_doi) ELSE reverse(citing_doi) END AS cited_id FROM refs)
            WHERE citing_doi <> cited_id""",
        "extract_table_function": """SELECT citing_doi, item_ord, ref_index, 'doi' AS mode, match_ord, raw AS raw_match, id AS identifier FROM d3
            UNION ALL SELECT citing_doi, item_ord, ref_index, 'arxiv', CAST(row_number() OVER (PARTITION BY item_ord, ref_index ORDER BY form, o) - 1 AS BIGINT), raw, id FROM a2 WHERE nth = 1""",
        "incremental_links": "SELECT citing_doi, cited_id, raw_match, provenance, ref_index FROM u WHERE citing_doi <> cited_id",
        "resolver_table": f"SELECT cited_id AS doi, CASE WHEN {even} THEN 'found' ELSE 'missing' END AS outcome, CASE WHEN {even} THEN '302' ELSE '404' END AS detail, CASE WHEN {even} THEN 'datacite' END AS matched_source FROM cs WHERE matched_source IS NULL",
        **{f"doi_{k}_jsonl": split.format("cited_id AS doi,", w, "u", w) for k, w in of.items()},
        **{f"arxiv_{k}_jsonl": split.format(arxiv, w, "ua", w) for k, w in of.items()},
    }
