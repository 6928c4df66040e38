"""What must stay as it is when the tables grow: tasks, files, lines of hot works."""

import pytest
from pyspark.sql import functions as F

from citeweave import fixtures
from citeweave.operators.extract import extract_edges
from citeweave.operators.invert import dedup_edges, dedup_links, link_counts
from citeweave.plans import stored
from citeweave.plans.pipeline import PipelineArgs, write_link_results
from citeweave.sinks import lines
from citeweave.sinks.outputs import compact_edges, split_path, write_inverted_links, write_partitioned_edges
from citeweave.sources.edges import read_ranked
from citeweave.sources.records import read_entries, read_heads
from citeweave.streaming.incremental import merge_links, read_links


@pytest.fixture(scope="module")
def edges(spark, sf_dir):
    extract_edges(fixtures.references(spark, sf_dir)).withColumn("ref_json", F.lit('{"kind":1}')).createOrReplaceTempView("edges_of_sizes")
    return spark.table("edges_of_sizes").cache()


def test_tasks_grow_with_the_lines(spark, sf_dir, monkeypatch):
    """A task sorts no more lines when there are more."""
    monkeypatch.setattr(fixtures, "TASK_LINES", 200)
    refs = fixtures.references(spark, sf_dir)
    assert fixtures.tasks(spark, sf_dir) == refs.rdd.getNumPartitions() == 30
    assert max(refs.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 400
    links = dedup_edges(fixtures.by_pair(spark, sf_dir, extract_edges(refs)))
    assert links.rdd.getNumPartitions() == 30
    assert links._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("hashpartitioning(citing_doi") == 1


def test_a_key_has_one_file_whatever_its_size(spark, edges, tmp_path):
    """AQE may not part a key."""
    write_partitioned_edges(edges, str(tmp_path / "e"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        compact_edges(spark, str(tmp_path / "e"), str(tmp_path / "one"))
        compact_edges(spark, str(tmp_path / "e"), str(tmp_path / "some"), largest_rows=400)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert {len(list(key.glob("*.parquet"))) for key in (tmp_path / "one").glob("pkey=*")} == {1}
    n = edges.where("cited_id LIKE '10.5061/%'").count()
    assert 1 < -(-n // 400) <= len(list((tmp_path / "some" / "pkey=10.5061").glob("*.parquet"))) <= 2 * -(-n // 400)
    for name in ("one", "some"):
        assert sorted(spark.read.parquet(str(tmp_path / name)).select(edges.columns).collect()) == sorted(edges.collect())


def test_heads_and_entries_of_hot_lines(spark, edges, tmp_path):
    """Hot works beside others, in splits smaller than a line; no row comes of the blank at the end of a file."""
    links = dedup_links(edges).cache()
    works = link_counts(links).withColumn("doi", F.col("cited_id"))
    path = str(tmp_path / "o.jsonl")
    lines.write_lines_split(links, works, path, hot=8)
    assert works.where("citation_count > 8").count() > 2
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        for kind, some in ((None, links), ("asserted", links.where("provenance <> 'mined'")), ("mined", links.where("provenance = 'mined'"))):
            heads = read_heads(spark, split_path(path, kind) if kind else path, ["doi", "citation_count"])
            assert sorted(map(tuple, heads.collect())) == sorted((r[0], str(r[1])) for r in link_counts(some).select("cited_id", "citation_count").collect())
        found = read_entries(spark, path).select("work", F.from_json("entry", "doi string, provenance string").alias("e"))
        assert sorted((r[0], r[1][0], r[1][1]) for r in found.collect()) == sorted(map(tuple, links.select("cited_id", "citing_doi", "provenance").collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_outputs_of_a_run_with_hot_works(spark, sf_dir, monkeypatch):
    """valid and failed outputs, read back, are the works, and none beside them."""
    monkeypatch.setattr(PipelineArgs, "hot", 5)
    monkeypatch.setattr(PipelineArgs.__init__, "__defaults__", tuple(5 if v == lines.HOT else v for v in PipelineArgs.__init__.__defaults__))
    found = stored.pipeline_outputs(spark, sf_dir)
    assert found.where("doi IS NULL").isEmpty() and found.count() > 500


def test_links_are_gathered_once_for_all_outputs(spark, edges, tmp_path):
    """twelve outputs of links and works take one exchange of links; the rest is narrow."""
    links = dedup_links(edges)
    links.write.parquet(str(tmp_path / "links"))
    links = spark.read.parquet(str(tmp_path / "links"))
    works = link_counts(links).withColumn("doi", F.col("cited_id")).withColumn("matched_source", F.when(F.col("doi").like("10.5061/%"), "datacite").when(F.length("doi") % 2 == 0, "crossref")).cache()
    works.count()
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    gathered = lines.gather(links, works)
    once, before = written() - before, written()
    paths = {s: str(tmp_path / s) for s in ("crossref", "datacite")}
    write_link_results(links, works, PipelineArgs("", outputs=paths, failed={s: f"{p}_failed" for s, p in paths.items()}))
    assert gathered.hot is None and written() - before < 1.5 * once
    assert read_heads(spark, paths["datacite"], ["doi"]).count() == works.where("matched_source = 'datacite'").count()


def test_a_merge_shuffles_new_links_twice(spark, edges, tmp_path):
    """once to compare pairs, once to deal ranges out."""
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    dedup_links(edges).hint("rebalance", F.col("cited_id")).write.parquet(str(tmp_path / "plain"))
    plain, before = written() - before, written()
    merge_links(edges, str(tmp_path / "l"), ranges=4)
    assert written() - before < 1.5 * plain
    merge_links(edges, str(tmp_path / "l"), ranges=4)
    assert read_links(spark, str(tmp_path / "l")).count() == dedup_links(edges).count()


def test_works_are_not_broadcast(spark, sf_dir):
    """The orders' keys make a small file however many they are."""
    plan = fixtures.references(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_hot_works_have_rows_of_parts(spark, edges, tmp_path):
    """no array of a hot work; files stay the ranking, and every link is in one part."""
    links, path = dedup_links(edges).cache(), str(tmp_path / "r")
    write_inverted_links(links, path, hot=8)
    rows = spark.read.parquet(path)
    counts = {r[0]: r[1] for r in link_counts(links).collect()}
    assert rows.where("parts > 1").select("cited_id").distinct().count() == sum(n > 8 for n in counts.values()) > 2
    assert rows.select(F.max(F.size("cited_by"))).first()[0] < max(counts.values()) / 3
    found = rows.select("cited_id", "part", F.explode("cited_by.doi").alias("doi"))
    assert sorted((r[0], r[2]) for r in found.collect()) == sorted((r["cited_id"], r["citing_doi"]) for r in links.collect())
    assert rows.groupBy("cited_id").agg(F.min("part").alias("p")).where("p <> 0").isEmpty()
    ranking = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    ranked = read_ranked(spark, path)
    assert [(r["rank"], r["cited_id"], r["citation_count"]) for r in ranked.orderBy("rank").collect()] == [(k + 1, c, counts[c]) for k, c in enumerate(ranking)]
    assert ranked.columns == ["cited_id", "citation_count", "reference_count", "cited_by", "rank"]
    assert "parts" in rows.columns and set(rows.where("parts = 1").select("part").distinct().toPandas()["part"]) == {0}


def test_links_of_ranges_are_shuffled_once(spark, edges, tmp_path):
    """a range's links are written by the tasks that compared their pairs."""
    from citeweave.plans.pipeline import invert_ranges
    from citeweave.streaming.commits import CommitLog, key_range

    edges.withColumn("key_range", key_range(F.col("cited_id"), 4)).write.parquet(str(tmp_path / "e"))
    stored_edges = spark.read.parquet(str(tmp_path / "e"))
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    stored_edges.repartition("citing_doi", "cited_id").write.format("noop").mode("overwrite").save()
    once, before = written() - before, written()
    found = invert_ranges(stored_edges, str(tmp_path / "l"), CommitLog(spark, str(tmp_path / "c"), "x"), 4, 4)
    assert written() - before < 1.5 * once
    assert sorted(map(tuple, found.select("citing_doi", "cited_id", "ref_index").collect())) == sorted(map(tuple, dedup_links(edges).select("citing_doi", "cited_id", "ref_index").collect()))
    assert found.where(key_range(F.col("cited_id"), 4) != F.col("key_range")).isEmpty()


def test_hot_records_are_validated_in_pieces(spark, edges, tmp_path, monkeypatch):
    """outputs are those of records read as lines, with no line of a hot file read whole."""
    import json

    from citeweave.plans import pipeline
    from citeweave.sources.records import files_of_hot, write_index

    links = dedup_links(edges).cache()
    works = link_counts(links).withColumn("doi", F.col("cited_id"))
    lines.write_lines(links, works, str(tmp_path / "in"), hot=8)
    with open(tmp_path / "in" / "part-by-hand.txt", "w") as f:  # of another layout, and beside hot ones one without entries
        f.write(json.dumps({"doi": "10.9/x", "reference_count": 90, "citation_count": 90, "cited_by": [{"doi": "10.9/y", "more": {"doi": 1}}]}) + "\n")
    with open(tmp_path / "in" / "part-compact.txt", "w") as f:
        for r in ({"doi": "10.9/none", "reference_count": 0, "citation_count": 0, "cited_by": []}, {"doi": "10.9/hot", "reference_count": 3, "citation_count": 20, "cited_by": [{"doi": "10.9/a", "provenance": "publisher", "n": [1]}, {"doi": "10.9/b"}]}):
            f.write(json.dumps(r, separators=(",", ":")) + "\n")
    write_index(works.where(F.length("doi") % 2 == 0).select("doi"), str(tmp_path / "ix"))
    with open(tmp_path / "in" / "part-nested.txt", "w") as f:
        f.write('{"doi":"10.9/nested","reference_count":1,"citation_count":1,"cited_by":[{"doi":"10.9/c","matches":[{"raw_match":"x","reference":{"doi":"y"}}]}]}\n')
    assert len(files_of_hot(spark, str(tmp_path / "in"), 8)) >= 2
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        for name, hot in (("whole", lines.HOT), ("pieces", 8)):
            monkeypatch.setattr(pipeline, "HOT", hot)
            pipeline.run_validate(spark, str(tmp_path / "in"), "crossref", str(tmp_path / f"{name}_v"), str(tmp_path / f"{name}_f"), crossref_index=str(tmp_path / "ix"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for out in ("v", "f", "v_asserted", "v_mined", "f_asserted", "f_mined"):
        read = lambda name: sorted(json.dumps(json.loads(x), sort_keys=True) for p in (tmp_path / f"{name}_{out}").glob("part-*") for x in p.read_text().splitlines() if x.strip())  # noqa: B023, E731
        assert read("whole") == read("pieces")
        assert out not in ("v", "f") or read("pieces")


def test_entries_are_read_back_without_moving_them(spark, edges, tmp_path):
    """what a line's entries are of is carried on within a split; only rows for splits are exchanged."""
    links = dedup_links(edges).cache()
    path = str(tmp_path / "o.jsonl")
    lines.write_lines(links, link_counts(links).withColumn("doi", F.col("cited_id")), path, hot=8)
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    links.repartition("cited_id").select("citing_doi").write.format("noop").mode("overwrite").save()
    before = written()
    links.repartition("cited_id").select("citing_doi").write.format("noop").mode("overwrite").save()
    once, before = written() - before, written()
    read_entries(spark, path).write.format("noop").mode("overwrite").save()
    assert written() - before < once / 4


def test_validation_keeps_its_texts_compressed(spark, edges, tmp_path, monkeypatch):
    """outputs in the codec asked for, of hot works too; nothing cached, and no scratch left."""
    from citeweave.plans import pipeline
    from citeweave.sources.records import write_index
    from citeweave.storage import exists

    links = dedup_links(edges).cache()
    works = link_counts(links).withColumn("doi", F.col("cited_id"))
    links.count()
    lines.write_gathered(lines.gather(links, works, hot=8), str(tmp_path / "in"), compression="gzip")
    write_index(works.where(F.length("doi") % 2 == 0).select("doi"), str(tmp_path / "ix"))
    monkeypatch.setattr(pipeline, "HOT", 8)
    held = []
    monkeypatch.setattr(pipeline, "scratch", lambda s: held.append(f"file://{tmp_path}/held{len(held)}") or held[-1])
    blocks = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    cached, seen, split = blocks(), [], pipeline.write_split
    monkeypatch.setattr(pipeline, "write_split", lambda *a: seen.append(blocks()) or split(*a))
    pipeline.run_validate(spark, str(tmp_path / "in"), "crossref", str(tmp_path / "v"), str(tmp_path / "f"), crossref_index=str(tmp_path / "ix"), compression="gzip")
    assert seen == [cached] * 2 and held and not any(exists(spark, h) for h in held)
    for out in ("v", "f", "v_asserted", "v_mined", "f_asserted", "f_mined"):
        assert {p.suffix for p in (tmp_path / out).glob("part-*")} == {".gz"}
    found = {(r[0], int(r[1])) for x in "vf" for r in read_heads(spark, str(tmp_path / x), ["doi", "citation_count"]).collect()}
    assert found == {(r[0], r[1]) for r in works.select("doi", "citation_count").collect()}


def test_entries_become_json_once(spark, edges):
    """outputs join texts that gather has made; null fields are left out of lines of all links alone."""
    links = dedup_links(edges).withColumn("ref_json", F.when(F.crc32("citing_doi") % 2 == 0, "no JSON {").otherwise(F.col("ref_json"))).limit(300).cache()
    found = lines.gather(links, link_counts(links).withColumn("doi", F.col("cited_id"))).few.select(F.inline("rows"))
    assert found.columns == ["asserted", "entry", "bare"]
    rows = found.collect()
    assert len(rows) == 300 and 0 < sum(r["bare"] is None for r in rows) < 300
    assert all((r["bare"] or r["entry"]) == r["entry"].replace('"reference":null,', "") and ('"reference":null' in r["entry"]) == (r["bare"] is not None) for r in rows)


def test_unnamed_runs_do_not_ask_for_files_one_by_one(spark, sf_dir, monkeypatch):
    """a digest of the input takes calls for each of its files, and only a named run has a use for it."""
    from citeweave.plans import pipeline

    monkeypatch.setattr(pipeline, "digest", lambda *a: pytest.fail("listed"))
    assert pipeline.run_digests(spark, PipelineArgs(sf_dir))[1] is None


def test_references_as_columns():
    """batches are those that Arrow makes of dicts, and texts of references those of the JSON encoder."""
    import json

    import pyarrow as pa

    from citeweave.sources import works

    odd = [{"DOI": "10.1/\u00e4\n\"", "zz": "\u2028", "URL": ""}, {}, {"DOI": 5, "unstructured": "x"}, {"a": {"b": None}, "URL": "u"}, [1, "x"], "text", None, 1.50]
    texts = [json.dumps(r, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in odd]
    refs = [works._reference(r) for r in odd]
    assert [r[-1] for r in refs] == texts
    assert refs[0][:2] == (odd[0]["DOI"], "") and refs[2][0] is None and refs[2][4] == "x" and refs[4][:-1] == (None,) * 6
    rows = [{"entry_path": "p", "entry_ord": k, "item_ord": k, "doi": None, "refs": r, "status": None} for k, r in enumerate(([], None, refs, refs[:1], []))]
    for some in (rows, rows[:2], rows[1:2], []):
        plain = [{**r, "refs": r["refs"] and [dict(zip(works.NAMES, x)) for x in r["refs"]]} for r in some]
        assert works._batch(some).equals(pa.RecordBatch.from_pylist(plain, works._ITEM))


def test_compressed_lines_lie_in_files_of_a_size(spark, edges, tmp_path, monkeypatch):
    """no file that is read whole by a task grows with the table."""
    monkeypatch.setattr(lines, "FILE_LINES", 20)
    links = dedup_links(edges).cache()
    works, path = link_counts(links).withColumn("doi", F.col("cited_id")), tmp_path / "o"
    lines.write_lines(links, works, str(path), compression="gzip")
    assert len(list(path.glob("part-*.gz"))) >= works.count() / 20 > 10
    assert sorted(r[0] for r in read_heads(spark, str(path), ["doi"]).collect()) == sorted(r[0] for r in works.select("doi").collect())


def test_texts_are_joined_by_runs(spark):
    """no array of all texts of a hot key; runs of one and of several splits stand in their order."""
    rows = spark.range(20_000).selectExpr("if(id % 5 = 0, 'cold', 'hot') AS work", "struct(20000 - id div 9000 AS split, id AS at) AS nth", "cast(id AS string) AS shown")
    found = stored.join_texts(rows.repartition(7), "work", "nth.split", "nth.at", "shown", ";")
    order = sorted(range(20_000), key=lambda k: (20_000 - k // 9000, k))
    assert dict(map(tuple, found.collect())) == {w: ";".join(str(k) for k in order if (k % 5 == 0) == (w == "cold")) for w in ("cold", "hot")}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2


def test_gathering_tasks_follow_the_links(spark, edges, tmp_path, monkeypatch):
    """a task gathers no more links when there are more; links of hot works are found without dealing out all links."""
    dedup_links(edges).write.parquet(str(tmp_path / "links"))
    links = spark.read.parquet(str(tmp_path / "links"))
    works = link_counts(links).withColumn("doi", F.col("cited_id"))
    monkeypatch.setattr(lines, "TASK_LINKS", 100)
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    links.repartition("cited_id").write.format("noop").mode("overwrite").save()
    once, before = written() - before, written()
    gathered = lines.gather(links, works, hot=8)
    assert written() - before < 1.8 * once
    assert spark.sparkContext.defaultParallelism < -(-links.count() // 100) / 2
    assert len(gathered.few.inputFiles()) > -(-links.count() // 100) / 2
    assert max(r["n"] for r in gathered.few.groupBy(F.input_file_name()).agg(F.sum(F.size("rows")).alias("n")).collect()) < 300
    counts = {r[0]: r[1] for r in link_counts(links).collect()}
    assert {r[0]: len(r[1]) for r in gathered.few.select("cited_id", "rows").collect()} == {c: n for c, n in counts.items() if n <= 8}
    assert gathered.hot.count() == sum(n for n in counts.values() if n > 8) > 20
