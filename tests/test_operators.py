"""Edges, deduplication, inversion, indexes, validation and sinks on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from citeweave.operators import index as ix
from citeweave.operators.extract import explode_references, extract_edges
from citeweave.operators.invert import best_provenance, citation_counts, dedup_edges, invert, ranked
from citeweave.operators.stats import extraction_stats, inversion_stats, partition_histogram
from citeweave.operators.resolve import resolve_unmatched
from citeweave.operators.validate import lookup, split_by_provenance, validation_stats
from citeweave.schemas import EDGES, WORKS
from citeweave.sinks.outputs import split_path, to_jsonl, write_partitioned_edges
from citeweave.sources.edges import read_partitioned_edges


def ref(**fields):
    names = ("doi_field", "url", "article_title", "journal_title", "unstructured", "asserted_by")
    return (*(fields.get(n) for n in names), json.dumps(fields))


@pytest.fixture
def works(spark):
    rows = [
        ("f", 0, 0, "10.1/Citing", [ref(doi_field="10.1111/A", asserted_by="publisher"), ref(unstructured="10.1111/a again"), ref(unstructured="10.1/citing? 10.1111/citing")]),
        ("f", 0, 1, "10.1111/CITING", [ref(unstructured="doi:10.1111/citing, 10.1111/b"), ref()]),
        ("f", 0, 2, None, [ref(unstructured="10.1111/a")]),
        ("f", 0, 3, "10.2222/x", [ref(journal_title="arXiv", unstructured="2403.12345 preprint")]),
    ]
    return spark.createDataFrame(rows, WORKS)


def edges(spark, rows):
    return spark.createDataFrame([(c, 0, 0, k, 0, "{}", d, d, p) for k, (c, d, p) in enumerate(rows)], EDGES)


def test_edges(works):
    refs = explode_references(works)
    made = extract_edges(refs)
    found = sorted((r["citing_doi"], r["ref_index"], r["match_ord"], r["cited_id"], r["provenance"]) for r in made.collect())
    assert found == [
        ("10.1/citing", 0, 0, "10.1111/a", "publisher"),
        ("10.1/citing", 1, 0, "10.1111/a", "mined"),
        ("10.1/citing", 2, 0, "10.1111/citing", "mined"),
        ("10.1111/citing", 0, 1, "10.1111/b", "mined"),
    ]
    assert extraction_stats(refs, made).first().asDict() == {"refs": 6, "items": 3, "matches": 4, "refs_with_matches": 4}
    assert [r["cited_id"] for r in extract_edges(refs, "arxiv").collect()] == ["2403.12345"]


def test_arxiv_self_citation_option(spark):
    works = spark.createDataFrame([("f", 0, 0, "10.48550/arXiv.2403.12345", [ref(unstructured="arXiv:2403.12345")])], WORKS)
    refs = explode_references(works)
    assert extract_edges(refs, "arxiv").count() == 1
    assert extract_edges(refs, "arxiv", compare_arxiv_doi=True).count() == 0


def test_dedup_first_and_best(spark):
    e = edges(spark, [("a", "x", "mined"), ("a", "x", "publisher"), ("b", "x", "crossref"), ("b", "b", "mined")])
    assert sorted((r[0], r[1], r["provenance"]) for r in dedup_edges(e).collect()) == [("a", "x", "mined"), ("b", "b", "mined"), ("b", "x", "crossref")]
    assert sorted((r[0], r["provenance"]) for r in dedup_edges(e, "best").collect()) == [("a", "publisher"), ("b", "crossref"), ("b", "mined")]
    assert sorted((r[0], r[1], r[2]) for r in best_provenance(e).collect()) == [("a", "x", "publisher"), ("b", "b", "mined"), ("b", "x", "crossref")]
    assert [tuple(r) for r in citation_counts(e).collect()] == [("x", 2, 2)]


def test_invert_and_rank(spark):
    e = edges(spark, [("b", "x", "mined"), ("a", "x", "publisher"), ("a", "y", "mined")])
    rows = ranked(invert(e)).collect()
    assert [(r["cited_id"], r["citation_count"], [c["doi"] for c in r["cited_by"]]) for r in rows] == [("x", 2, ["a", "b"]), ("y", 1, ["a"])]
    assert invert(e, "arxiv").first()["arxiv_doi"].startswith("10.48550/arXiv.")
    assert inversion_stats(citation_counts(e)).first().asDict() == {"unique_works": 2, "citations": 3}
    assert inversion_stats(citation_counts(e.limit(0))).first().asDict() == {"unique_works": 0, "citations": 0}
    assert {r["pkey"]: r["n_edges"] for r in partition_histogram(e).collect()} == {"x": 2, "y": 1}


def test_counts_need_no_lists(spark):
    plan = citation_counts(edges(spark, [("a", "x", "mined")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan


def test_indexes(spark):
    a = ix.build_index(spark.createDataFrame([("10.1111/A",), ("10.1111/a",), (None,), ("10.2222/b",)], "doi string"))
    b = ix.build_index(spark.createDataFrame([("10.2222/c",), ("10.3333/d",)], "doi string"))
    assert sorted(r[0] for r in ix.merge_indexes(a, b).collect()) == ["10.1111/a", "10.2222/b", "10.2222/c", "10.3333/d"]
    assert ix.index_stats(ix.merge_indexes(a, b)).first().asDict() == {"dois": 4, "prefixes": 3}
    cited = spark.createDataFrame([("10.1111/z",), ("10.2222/z",), ("10.3333/z",), ("10.4444/z",), ("nothing",)], "cited_id string")
    assert {r[0]: r[1] for r in ix.prefix_source(cited, a, b).collect()} == {"10.1111/z": "crossref", "10.2222/z": "both", "10.3333/z": "datacite", "10.4444/z": "none", "nothing": "none"}
    assert sorted(r[0] for r in ix.with_known_prefix(cited, a).collect()) == ["10.1111/z", "10.2222/z"]


def citations(spark, rows):
    schema = "doi string, reference_count bigint, citation_count bigint, cited_by array<struct<doi string, provenance string, matches array<struct<raw_match string, reference string, provenance string>>>>"
    return spark.createDataFrame([(d, len(ps), len(ps), [(f"c{k}", p, [("r", '{"b":1,"a":"x"}', p)]) for k, p in enumerate(ps)]) for d, ps in rows], schema)


def test_lookup(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "doi string") for xs in (["10.1/a", "10.1/both"], ["10.1/b", "10.1/both"]))
    c = citations(spark, [(d, ["mined"]) for d in ("10.1/A", "10.1/b", "10.1/BOTH", "10.1/none")])
    got = {s: {r["doi"]: r["matched_source"] for r in lookup(c, s, a, b).collect()} for s in ("all", "crossref", "datacite", "arxiv")}
    assert got["all"] == {"10.1/A": "crossref", "10.1/b": "datacite", "10.1/BOTH": "crossref", "10.1/none": None}
    assert got["crossref"] == {"10.1/A": "crossref", "10.1/b": None, "10.1/BOTH": "crossref", "10.1/none": None}
    assert got["datacite"] == got["arxiv"] == {"10.1/A": None, "10.1/b": "datacite", "10.1/BOTH": "datacite", "10.1/none": None}
    looked = lookup(c, "all", a, b)
    assert validation_stats(looked).first().asDict() == {"total": 4, "crossref_matched": 2, "datacite_matched": 1, "failed": 1}
    resolved = resolve_unmatched(looked, lambda doi: doi.endswith("none"), "all", concurrency=4, partitions=2)
    assert {r["doi"]: r["matched_source"] for r in resolved.collect()}["10.1/none"] == "datacite"
    assert resolve_unmatched(looked, lambda doi: False, "crossref").where("matched_source IS NULL").count() == 1


def test_split_and_jsonl(spark):
    c = citations(spark, [("10.1/a", ["publisher", "mined", "crossref"]), ("10.1/b", ["mined", None])])
    kept = {k: {r["doi"]: (r["citation_count"], r["reference_count"]) for r in split_by_provenance(c, k).collect()} for k in (True, False)}
    assert kept == {True: {"10.1/a": (2, 3)}, False: {"10.1/a": (1, 3), "10.1/b": (2, 2)}}
    one = json.loads(to_jsonl(c.where("doi = '10.1/a'")).first()[0])
    assert list(one) == ["doi", "reference_count", "citation_count", "cited_by"]
    assert one["cited_by"][0] == {"doi": "c0", "provenance": "publisher", "matches": [{"raw_match": "r", "reference": {"a": "x", "b": 1}, "provenance": "publisher"}]}
    assert json.loads(to_jsonl(c, keep_null_id=True).first()[0])["arxiv_id"] is None
    arxiv = c.withColumn("doi", F.lit("10.48550/arXiv.2403.1"))
    assert json.loads(to_jsonl(arxiv, arxiv=True).first()[0])["arxiv_id"] == "2403.1"


def test_split_path():
    assert split_path("/a/b.jsonl", "mined") == "/a/b_mined.jsonl"
    assert split_path("b", "asserted") == "b_asserted"
    assert split_path("a.b/c.d.jsonl", "mined") == "a.b/c.d_mined.jsonl"


def test_partitioned_edges(spark, tmp_path):
    write_partitioned_edges(edges(spark, [("a", "10.1110/x", "mined"), ("a", "10.1110/y", "mined"), ("a", "2403.1", "mined")]), str(tmp_path / "e"))
    back = read_partitioned_edges(spark, str(tmp_path / "e"))
    assert {r["pkey"]: r["n"] for r in back.groupBy("pkey").agg(F.count("*").alias("n")).collect()} == {"10.1110": 2, "2403": 1}
    pruned = back.where("pkey = '10.1110'")
    assert pruned.count() == 2 and "PartitionFilters: [isnotnull(pkey" in pruned._jdf.queryExecution().executedPlan().toString()
