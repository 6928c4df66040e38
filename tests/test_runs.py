"""Runs that end and go on, counters, hot works, numbered errors, ranked files, pruned indexes, remembered answers."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from citeweave import cli
from citeweave.functions.elapsed import elapsed, format_elapsed
from citeweave.operators.invert import dedup_links, invert
from citeweave.operators.resolve import ANSWERS, ask, head_resolver, head_status, outcome, resolve_unmatched
from citeweave.plans.pipeline import PipelineArgs, run_pipeline
from citeweave.schemas import EDGES
from citeweave.sinks import lines as sink
from citeweave.sinks import outputs
from citeweave.sinks.outputs import compact_edges, split_path, split_path_of, to_jsonl, write_inverted, write_partitioned_edges
from citeweave.sources import records as indexes
from citeweave.sources.edges import read_partitioned_edges, read_ranked
from citeweave.sources.works import items, members, scan_archives, scan_directory
from citeweave.storage import digest
from citeweave.streaming.commits import CommitLog
from citeweave.streaming.manifest import Manifest

from .test_plans import WORKS_A, archive, by_id, lines, records, ruled_works, works


def edges(spark, pairs):
    rows = [(c, 0, 0, k, 0, json.dumps({"n": k, "s": "a b"}), d, d, p) for k, (c, d, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, EDGES)


# Runs that go on


def test_a_run_killed_between_ranges(spark, tmp_path):
    made, _ = ruled_works(4)
    source = works(tmp_path / "w.tar.gz", made + WORKS_A)
    plain = PipelineArgs(source, "crossref", None, {"crossref": str(tmp_path / "plain")}, {"crossref": str(tmp_path / "plain_f")}, temp_dir=str(tmp_path / "t"))
    whole = run_pipeline(spark, plain)["stats"]
    args = PipelineArgs(source, "crossref", None, {"crossref": str(tmp_path / "o")}, {"crossref": str(tmp_path / "f")}, temp_dir=str(tmp_path / "t"), run_id="k", ranges=6, ranges_at_once=1, keep_intermediates=True)
    seen = []

    def ends(now):
        seen.extend(now)
        if len(seen) == 3:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        run_pipeline(spark, args, on_commit=ends)
    assert Manifest.load(spark, str(tmp_path / "t/run-k/manifest")).phase == "invert"
    first = list(seen)
    resumed = run_pipeline(spark, args, on_commit=seen.extend)["stats"]
    assert first == [0, 1, 2] and seen == [0, 1, 2, 3, 4, 5] and resumed == whole
    key = lambda r: r["doi"]
    for name in ("", "_f", "_asserted", "_mined"):
        assert sorted(lines(tmp_path / f"o{name}".replace("o_f", "f")), key=key) == sorted(lines(tmp_path / f"plain{name}"), key=key)
    again = run_pipeline(spark, args, on_commit=seen.extend)["stats"]
    assert len(seen) == 6 and again == whole


def test_what_was_written_and_not_committed_is_written_anew(spark, tmp_path):
    from citeweave.plans.pipeline import invert_ranges
    from citeweave.streaming.commits import key_range

    e = edges(spark, [(f"c{k % 5}", f"d{k % 7}", "mined") for k in range(70)]).withColumn("key_range", key_range(F.col("cited_id"), 3))
    log, other = (CommitLog(spark, str(tmp_path / "log"), run) for run in ("a", "b"))
    invert_ranges(e.where("key_range = 1"), str(tmp_path / "links"), other, 3, 1)
    found = invert_ranges(e, str(tmp_path / "links"), log, 3, 2)
    assert found.count() == 35 and sorted(r["key"] for r in log.finished("invert").collect()) == ["0", "1", "2"]
    assert log.finished("invert").agg(F.sum("n")).first()[0] == 35
    assert log.pending(spark.range(5), F.col("id"), "invert").count() == 2


def test_another_source_or_input_under_a_run_is_refused(spark, tmp_path, capsys):
    source, known = works(tmp_path / "w.tar.gz", WORKS_A), records(tmp_path / "r.jsonl.gz", "10.7070/cores")
    args = ["pipeline", "-i", source, "--temp-dir", str(tmp_path / "t"), "--run-id", "r", "--ranges", "2", "--keep-intermediates", "--datacite-records", known]
    assert cli.main([*args, "--source", "crossref", "--output-crossref", str(tmp_path / "c")], spark) == 0
    assert cli.main([*args, "--source", "datacite", "--output-datacite", str(tmp_path / "d")], spark) == 2
    assert "other options" in capsys.readouterr().err and not (tmp_path / "d").exists()
    assert cli.main([*args, "--source", "crossref", "--output-crossref", str(tmp_path / "c2")], spark) == 0
    assert by_id(tmp_path / "c2") == by_id(tmp_path / "c")
    time.sleep(1.1)
    works(tmp_path / "w.tar.gz", WORKS_A[:1])
    assert cli.main([*args, "--source", "crossref", "--output-crossref", str(tmp_path / "c")], spark) == 2


def test_digest(spark, tmp_path):
    assert digest(spark, str(tmp_path / "none")) is None
    (tmp_path / "a").write_text("x")
    one = digest(spark, str(tmp_path))
    (tmp_path / "b").write_text("y")
    assert one != digest(spark, str(tmp_path)) == digest(spark, f"{tmp_path}/*")


# Counters and members


def test_counters_of_a_run(spark, tmp_path):
    made, expected = ruled_works(2)
    source = works(tmp_path / "w.tar.gz", [*made, {"DOI": "10.3030/plant-0"}, {"title": "none"}, {"DOI": "10.1111/x", "reference": [{"DOI": "10.1111/X"}, {"unstructured": "10.7777/a 10.7777/b"}]}])
    stats = run_pipeline(spark, PipelineArgs(source, "crossref", None, {"crossref": str(tmp_path / "o")}, http_fallback=("crossref",), temp_dir=str(tmp_path / "t")), resolver=lambda doi: doi == "10.7777/a")["stats"]
    n = len(expected)
    assert stats == {"files": 2, "rejected": 1, "items": n + 5, "indexed": n + 4, "matches": 2 * n + 2, "refs_with_matches": 2 * n + 1, "works": n + 2, "citations": 2 * n + 2, "crossref_matched": n, "datacite_matched": 0, "resolved": 1, "failed": 1}
    none = run_pipeline(spark, PipelineArgs(works(tmp_path / "e.tar.gz", []), "crossref", None, {"crossref": str(tmp_path / "e")}, temp_dir=str(tmp_path / "t")))["stats"]
    assert none["files"] == 2 and sum(none.values()) == 3


def test_members_of_archives_and_folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    odd = json.dumps({"items": [{"DOI": "10.1/é", "reference": [{"unstructured": "x\ny"}]}]}, indent=1, ensure_ascii=False).replace("\n", "\r\n").encode()
    contents = [("a/é\r.json", odd), ("b.json", b"{"), ("c.JSON", b"{}"), ("d.json", b'{"items": [1, {"DOI": 3}]}'), ("e.json", b"[" * 100_000), ("f.json", b'{"items": [{"DOI": "10.1/' + b"x" * 5000 + b'"}]}'), ("g.json", b"\xff"), ("h.json", b"")]
    archive(tmp_path / "in/x.tar.gz", *contents)
    archive(tmp_path / "in/y.tar.gz", ("z.json", b'{"items": [{"DOI": "10.1/z"}]}'))
    archive(tmp_path / "in/empty.tar.gz")
    found = scan_archives(spark, str(tmp_path / "in"), largest=4000)
    said = {r["entry_path"].rpartition("!")[2]: r["status"].split(":")[0] for r in members(found).collect()}
    assert said == {"a/é\r.json": "read", "b.json": "malformed", "d.json": "read", "e.json": "too large", "f.json": "too large", "g.json": "malformed", "h.json": "malformed", "z.json": "read"}
    assert [r["doi"] for r in items(found).orderBy("entry_ord", "item_ord").collect()] == ["10.1/é", None, None, "10.1/z"]
    (tmp_path / "out").mkdir()
    for name, content in contents:
        (tmp_path / "out" / name.replace("/", "_")).write_bytes(content)
    found = scan_directory(spark, str(tmp_path / "out"), largest=4000)
    assert sorted(r["status"].split(":")[0] for r in members(found).collect()) == sorted(v for k, v in said.items() if k not in ("z.json", "h.json"))
    assert [r["doi"] for r in items(found).orderBy("entry_ord", "item_ord").collect()] == ["10.1/é", None, None]


def test_archives_of_another_store(spark, tmp_path):
    """A path that Python cannot open."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.far.link./in", f"file://{tmp_path}")
    works(tmp_path / "w.tar.gz", WORKS_A)
    assert items(scan_archives(spark, "viewfs://far/in/w.tar.gz")).count() == 4
    stats = run_pipeline(spark, PipelineArgs("viewfs://far/in", "crossref", None, {"crossref": "viewfs://far/in/o"}, temp_dir="viewfs://far/in/t", run_id="far", ranges=2))["stats"]
    assert stats["files"] == 2 and by_id(tmp_path / "o") == {"10.3030/reeds": 1} and not list((tmp_path / "t").glob("run-*"))


def test_a_broken_archive_fails(spark, tmp_path):
    whole = works(tmp_path / "w.tar.gz", WORKS_A)
    (tmp_path / "cut.tar.gz").write_bytes(open(whole, "rb").read()[:300])
    with pytest.raises(Exception):
        scan_archives(spark, str(tmp_path / "cut.tar.gz")).collect()


# Hot works


@pytest.mark.parametrize("arxiv", [False, True])
def test_hot_lines_equal_gathered_ones(spark, tmp_path, arxiv):
    kinds = ["publisher", "mined", "crossref", None]
    pairs = [(f"c{k:04}", "hot", kinds[k % 3]) for k in range(900)] + [(f"c{k:04}", f"d{k % 300}", kinds[k % 4]) for k in range(900)] + [("é\"\\", "hot", "mined"), ("one", "d7", "mined")]
    links = dedup_links(edges(spark, pairs).withColumn("ref_json", F.when(F.col("ref_index") % 5 != 0, F.col("ref_json")).otherwise("no JSON")))
    mode = "arxiv" if arxiv else "doi"
    inverted = invert(links, mode).withColumn("doi", F.col("arxiv_doi" if arxiv else "cited_id"))
    works_ = inverted.select("cited_id", "doi", "reference_count")
    sink.write_lines_split(links, works_, str(tmp_path / "o.jsonl"), arxiv, hot=100)
    from citeweave.operators.validate import split_by_provenance

    for kind in (None, "asserted", "mined"):
        whole = inverted if kind is None else split_by_provenance(inverted, kind == "asserted")
        expected = sorted(r[0] for r in to_jsonl(whole.drop("arxiv_id"), arxiv, keep_null_id=kind is not None).collect())
        path = tmp_path / (f"o_{kind}.jsonl" if kind else "o.jsonl")
        texts = [x.strip() for p in path.glob("part-*") for x in p.read_text().split("\n") if x.strip()]
        assert sorted(json.loads(x)["citation_count"] for x in texts) == sorted(json.loads(x)["citation_count"] for x in expected)
        # The same line, but for the blanks between a hot work's entries.
        assert sorted(x.replace("[ {", "[{").replace("} ,{", "},{").replace("} ]", "}]") for x in texts) == expected


def test_a_hot_work_is_nowhere_one_array(spark):
    links = edges(spark, [("a", "x", "mined")])
    many = spark.createDataFrame([("x", 1, "a", ("x", 1, 1))], "cited_id string, citation_count bigint, least string, head struct<doi string, reference_count bigint, citation_count bigint>")
    plan = sink._hot_lines(links, many, False)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan and "Sort" in plan


# Numbered errors


def test_bad_records_have_the_number_of_their_file(spark, tmp_path):
    good = json.dumps({"doi": "10.1/a", "reference_count": 1, "citation_count": 1, "cited_by": []})
    text = [good, "", " \t", good, "  ", "{", good, json.dumps({"doi": "x"}), *[good] * 400, '{"doi": 3', good]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/a.jsonl").write_text("\n".join(text))
    (tmp_path / "c/b.jsonl").write_text("\n".join([good, "", "[]"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert indexes.numbered_records(spark, str(tmp_path / "c")).count() == 409
        found = sorted((r["file"][-7], r["number"], r["reason"]) for r in indexes.bad_records(spark, str(tmp_path / "c")).collect())
        frame = indexes._lines(spark, str(tmp_path / "c"))
        assert frame.select("split").distinct().count() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [x for x in found if x[0] == "a"] == [("a", 3, "malformed"), ("a", 5, "lacks a required field"), ("a", 406, "malformed")]
    assert [x[:2] for x in found if x[0] == "b"] == [("b", 2)]


def test_validate_names_the_record(spark, tmp_path, capsys):
    good = json.dumps({"doi": "10.1/a", "reference_count": 1, "citation_count": 1, "cited_by": []})
    (tmp_path / "c").write_text(f"{good}\n \n\n{good}\n{good[:20]}\n{good}")
    indexes.write_index(spark.createDataFrame([("10.1/a",)], "doi string"), str(tmp_path / "ix"))
    args = ["validate", "-i", str(tmp_path / "c"), "--source", "crossref", "--crossref-index", str(tmp_path / "ix"), "--output-valid", str(tmp_path / "v"), "--output-failed", str(tmp_path / "f")]
    assert cli.main(args, spark) == 2
    assert "at line 3 of" in capsys.readouterr().err


# Ranked files, compaction, indexes


def test_files_are_the_ranking(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(outputs, "RANKED_GROUP", 40)
    e = edges(spark, [(f"c{k}", f"d{k * k % 331}", "mined") for k in range(2000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_inverted(invert(e), str(tmp_path / "r"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    import pyarrow.parquet as pq

    files = sorted((tmp_path / "r").glob("part-*"))
    assert len(files) > 1 and all(pq.ParquetFile(f).metadata.row_group(g).num_rows <= 40 for f in files for g in range(pq.ParquetFile(f).metadata.num_row_groups))
    inside = [(x["citation_count"], x["cited_id"]) for f in files for x in pq.read_table(f, columns=["citation_count", "cited_id"]).to_pylist()]
    assert inside == sorted(inside, key=lambda x: (-x[0], x[1]))
    ranked = read_ranked(spark, str(tmp_path / "r"))
    assert [r["cited_id"] for r in ranked.orderBy("rank").collect()] == [d for _, d in inside] and ranked.agg(F.max("rank")).first()[0] == len(inside)
    assert "Sort" not in ranked._jdf.queryExecution().executedPlan().toString().split("Window")[0]


def test_files_follow_bytes_not_tasks(spark, tmp_path):
    e = edges(spark, [(f"c{k}", "10.1000/hot" if k % 2 else f"10.{1001 + k % 7}/{k}", "mined") for k in range(4000)]).repartition(16)
    write_partitioned_edges(e, str(tmp_path / "e"))
    count = lambda p: {d.name: len(list(d.glob("*.parquet"))) for d in p.glob("pkey=*")}
    assert set(count(tmp_path / "e").values()) == {1} and len(count(tmp_path / "e")) == 8
    for _ in range(3):
        write_partitioned_edges(e, str(tmp_path / "e"), "append")
    assert set(count(tmp_path / "e").values()) == {4}
    compact_edges(spark, str(tmp_path / "e"), str(tmp_path / "compact"))
    assert set(count(tmp_path / "compact").values()) == {1} and read_partitioned_edges(spark, str(tmp_path / "compact")).count() == 16000
    write_partitioned_edges(e, str(tmp_path / "small"), largest_rows=500)
    assert count(tmp_path / "small")["pkey=10.1000"] == 4


def scanned_rows(frame):
    """Rows that the scan of a plan without shuffles handed on."""
    frame._jdf.queryExecution().executedPlan()
    frame._jdf.collectToPython()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_an_index_is_read_near_its_probes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(indexes, "INDEX_GROUP", 50)
    path = str(tmp_path / "ix")
    indexes.write_index(spark.range(4000).select(F.concat(F.lit("10."), (1000 + F.col("id") % 40).cast("string"), F.lit("/w"), F.col("id").cast("string")).alias("doi")), path)
    probes = spark.createDataFrame([("10.1007/W7",), ("10.1007/none",), ("10.1030/w30",), ("10.9/x",), ("nothing",), (None,)], "doi string")
    assert indexes.probed_ranges(spark, path, probes, "doi") == [("10.1007", "10.1007"), ("10.1030", "10.1030")]
    near = spark.read.parquet(path).where("(doi >= '10.1007/' AND doi < '10.10070') OR (doi >= '10.1030/' AND doi < '10.10300')")
    assert scanned_rows(near) < 500 < scanned_rows(spark.read.parquet(path)) == 4000
    pruned = indexes.read_index(spark, path, probes)
    assert "GreaterThanOrEqual(doi,10.1007/)" in pruned._jdf.queryExecution().executedPlan().toString()
    both = [probes.join(i, F.lower(probes["doi"]) == i["doi"], "left_semi").collect() for i in (pruned, indexes.read_index(spark, path))]
    assert sorted(both[0]) == sorted(both[1]) and len(both[0]) == 2
    assert indexes.read_index(spark, path, probes.where("doi = '10.9/x'")).count() == 0
    assert indexes.read_prefixes(spark, path).count() == 40


def test_an_index_without_prefixes_or_with_letters_is_read_whole(spark, tmp_path):
    spark.createDataFrame([("10.1/A",), ("10.1/b",)], "doi string").write.parquet(str(tmp_path / "ix"))
    probes = spark.createDataFrame([("10.1/a",), ("10.1X/a",)], "doi string")
    assert indexes.read_index(spark, str(tmp_path / "ix"), probes).count() == 2
    assert [r[0] for r in indexes.read_prefixes(spark, str(tmp_path / "ix")).collect()] == ["10.1"]
    indexes.write_index(spark.createDataFrame([("10.1x/a",)], "doi string"), str(tmp_path / "letters"))
    assert indexes.probed_ranges(spark, str(tmp_path / "letters"), probes, "doi") is None


# Resolver


@pytest.fixture
def registry():
    """A local server: the path says the status; it counts what is asked, and how much at once."""

    class Answers(BaseHTTPRequestHandler):
        def do_HEAD(self):
            state["asked"].append(self.path)
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
            time.sleep(0.05)
            kind = self.path.rsplit("/", 1)[1]
            if kind == "slow":
                time.sleep(1.5)
            passing = kind == "later" and state["asked"].count(self.path) < 3
            state["now"] -= 1
            self.send_response(503 if passing else 200 if kind in ("later", "slow") else int(kind[:3]))
            self.send_header("Location", "http://localhost:1/never")
            self.end_headers()

        def log_message(self, *args):
            pass

    state = {"asked": [], "now": 0, "most": 0}
    server = ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/", state
    server.shutdown()


def test_statuses_and_errors(registry):
    base, state = registry
    status = head_status(0.5, base)
    assert [outcome(status, f"10.1/{k}")[0] for k in ("200", "204", "302", "301", "404", "410", "503", "429", "slow")] == ["found"] * 4 + ["missing"] * 2 + ["error"] * 3
    assert outcome(status, "10.1/later", retries=3, pause=0.01) == ("found", "200") and outcome(status, "10.2/later", retries=1, pause=0.01) == ("error", "503")
    assert outcome(head_status(0.5, "http://127.0.0.1:1/"), "10.1/x")[0] == "error"
    resolver = head_resolver(0.5, base)
    assert [resolver(f"10.3/{k}") for k in ("200", "307", "404", "500", "slow")] == [True, True, False, False, False]
    assert state["asked"].count("/10.1/404") == 1
    with pytest.raises(ZeroDivisionError):
        outcome(lambda doi: 1 / 0, "10.1/x")


@pytest.mark.parametrize(("concurrency", "most"), [(1, 1), (3, 3)])
def test_one_bound_on_requests(spark, registry, concurrency, most):
    base, state = registry
    unknown = spark.createDataFrame([(f"10.1/200?{k}",) for k in range(20)], "doi string")
    rows = ask(unknown, head_status(5, base), concurrency).collect()
    assert len(rows) == 20 and {r["outcome"] for r in rows} == {"found"} and 1 <= state["most"] <= most


def test_answers_are_remembered(spark, tmp_path, registry):
    base, state = registry
    looked = spark.createDataFrame([("10.1/200", None), ("10.1/404", None), ("10.1/503", None), ("10.1/a", "crossref"), ("10.1/200", None), (None, None)], "doi string, matched_source string")
    table = str(tmp_path / "answers")
    for run in range(2):
        found = resolve_unmatched(looked, head_status(2, base), "crossref", concurrency=4, table=table)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted([("10.1/200", "crossref"), ("10.1/404", None), ("10.1/503", None), ("10.1/a", "crossref"), ("10.1/200", "crossref"), (None, None)], key=repr)
        # Each is asked once; the second run asks for what ended in an error alone.
        assert sorted(state["asked"]) == sorted(["/10.1/200", "/10.1/404", "/10.1/503"] + ["/10.1/503"] * run)
    assert spark.read.schema(ANSWERS).parquet(table).count() == 4


# Columns


def test_columns_equal_functions(spark):
    shown = [0, 1, 999, 1000, 59_999, 60_000, 61_001, 3_599_999, 3_600_000, 90_061_007]
    rows = spark.createDataFrame([(x,) for x in shown], "ms bigint").select("ms", elapsed(F.col("ms")).alias("s")).collect()
    assert all(r["s"] == format_elapsed(r["ms"] / 1000) for r in rows)
    paths = ["/a/b.jsonl", "b", "a.b/c.d.jsonl", "a.b/c", "x/.hidden", "x/.hidden.gz", "a..b"]
    found = spark.createDataFrame([(p,) for p in paths], "p string").select("p", split_path_of(F.col("p"), "mined").alias("s")).collect()
    assert {r["p"]: r["s"] for r in found} == {p: split_path(p, "mined") for p in paths}


# Table function, arrivals, packaging


def test_table_function(spark):
    from citeweave.functions.arxiv import arxiv_matches
    from citeweave.functions.doi import doi_matches
    from citeweave.functions.tables import register

    register(spark)
    texts = ["10.1234/A. and doi:10.1234/a; 10.99999/x y 10.1234%2Fb 10.1234/q%2Fz&gt;", "arXiv:2403.03542v2, arxiv.org/abs/2403.03542 arXiv: hep-ph/ 9901001v2 arXiv:solv-int/9901001v2", "it's \"10.1016/S0140-6736(05)1\"", "", None]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    found = spark.sql("SELECT k, 'doi' AS mode, f.* FROM {t}, LATERAL extract_identifiers(text, 'doi') f UNION ALL SELECT k, 'arxiv', f.* FROM {t}, LATERAL extract_identifiers(text, 'arxiv') f", t=frame)
    plain = [frame.select("k", F.lit(m).alias("mode"), F.posexplode(f(F.col("text"))).alias("o", "m")).select("k", "mode", "o", "m.*") for m, f in (("doi", doi_matches), ("arxiv", arxiv_matches))]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain[0].union(plain[1]).collect())) and found.count() > 6
    assert spark.sql("SELECT * FROM extract_identifiers('10.1234/a', 'other')").count() == 0
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_arrivals_equal_one_batch(spark, tmp_path):
    from citeweave.streaming.incremental import merge_links, read_links

    rows = [(f"c{k % 40}", k // 40, k % 7, k % 3, 0, "{}", f"r{k}", f"d{k % 23}", "mined") for k in range(600)]
    whole = spark.createDataFrame(rows, EDGES)
    path = str(tmp_path / "links")
    late, early = whole.where("entry_ord >= 5"), whole.where("entry_ord < 8")
    for part in (late, early, early.limit(50), whole.limit(0)):
        merge_links(part, path, ranges=5)
    merge_links(whole.where("cited_id = 'd3'"), path, ranges=5)
    assert sorted(map(tuple, read_links(spark, path).drop("key_range").collect())) == sorted(map(tuple, dedup_links(whole).select(*read_links(spark, path).drop("key_range").columns).collect()))
    assert not (tmp_path / "links_merged").exists()


def test_only_touched_ranges_are_written(spark, tmp_path):
    from citeweave.streaming.incremental import merge_links

    merge_links(edges(spark, [(f"c{k}", f"d{k}", "mined") for k in range(60)]), str(tmp_path / "l"), ranges=6)
    before = {p.name: sorted(x.name for x in p.iterdir()) for p in (tmp_path / "l").glob("key_range=*")}
    merge_links(edges(spark, [("new", "d1", "mined")]), str(tmp_path / "l"), ranges=6)
    after = {p.name: sorted(x.name for x in p.iterdir()) for p in (tmp_path / "l").glob("key_range=*")}
    assert len(before) == 6 and sum(before[k] != after[k] for k in before) == 1


def test_workers_get_the_package(tmp_path):
    """A session in another folder, without this one on its path."""
    import subprocess
    import sys
    from pathlib import Path

    code = (
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})\n"
        "from citeweave.session import get_session\nfrom citeweave.sources.works import scan_directory\n"
        "spark = get_session('x', 'local-cluster[1,1,1024]', **{'spark.ui.enabled': 'false', 'spark.driver.host': '127.0.0.1'})\n"
        "open('a.json', 'w').write('{\"items\": [{\"DOI\": \"10.1/a\"}]}')\n"
        f"print(scan_directory(spark, {str(tmp_path)!r}).count())"
    )
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**__import__("os").environ, "PYTHONPATH": ""}, timeout=300)
    assert said.stdout.strip() == "2", said.stderr[-2000:]


def test_a_named_run_without_matches(spark, tmp_path):
    source = works(tmp_path / "w.tar.gz", [{"DOI": "10.1234/a", "reference": [{"unstructured": "none"}]}])
    args = PipelineArgs(source, "crossref", None, {"crossref": str(tmp_path / "o")}, {"crossref": str(tmp_path / "f")}, temp_dir=str(tmp_path / "t"), run_id="none", ranges=3, keep_intermediates=True)
    for _ in range(2):
        stats = run_pipeline(spark, args)["stats"]
        assert stats["files"] == 2 and stats["matches"] == stats["works"] == 0 and not lines(tmp_path / "o") and not lines(tmp_path / "f")
