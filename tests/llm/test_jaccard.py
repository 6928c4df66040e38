"""The join and its components against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import jaccard
from citeweave.llm.catalogue import op10_ngram_jaccard_join
from citeweave.llm.graph import components

from .common import awkward, empty, near_copies, plain_components, shingles


def check(spark, texts, k, percent):
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_components(docs, jaccard.Join(k, percent)).collect()}
    assert got == plain_components(texts, k, percent)


@pytest.mark.parametrize(("k", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (2, 50, 3)])
def test_random_texts(spark, k, percent, seed):
    check(spark, near_copies(seed), k, percent)


@pytest.mark.parametrize("seed", [4, 5])
def test_large_buckets_are_parted(spark, monkeypatch, seed):
    """Tiny limits: every bucket goes by size classes and pairs of shares, and every component is too large for one."""
    monkeypatch.setattr(jaccard, "BUCKET_SHINGLES", 60)
    monkeypatch.setattr(jaccard, "MAX_FREQUENT", 5)
    check(spark, near_copies(seed, 80, 12, 40), 2, 70)


def test_query_on_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op10_ngram_jaccard_join(spark, sf_dir).collect()}
    assert got == plain_components(rows, 3, 90)


def test_edge_at_the_threshold(spark):
    """18 of 20 shared shingles link at 90, 17 of 19 do not."""
    base = [f"a{i}" for i in range(21)]
    texts = [(1, " ".join(base)), (2, " ".join(base[:20])), (3, " ".join(base[1:20]))]
    check(spark, texts, 3, 90)
    assert plain_components(texts, 3, 90)[2][1] == 1


def test_one_hot_group(spark):
    """Half of the rows are copies of one text and near copies of it."""
    base = [f"b{i}" for i in range(100)]
    texts = [(k, " ".join(base)) for k in range(300)] + [(300 + k, " ".join([*base[:-1], f"x{k}"])) for k in range(300)] + [(1000 + k, f"other {k} text") for k in range(50)]
    check(spark, texts, 5, 80)


def test_awkward_rows(spark):
    rows = jaccard.link_components(awkward(spark), jaccard.Join(3, 90)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 8 and got[2]["n_shingles"] == got[3]["n_shingles"] == got[4]["n_shingles"] == 0
    assert all(got[d]["component_id"] == d for d in (1, 2, 3, 4, 5, 7, 8))
    assert got[5]["n_shingles"] == 1
    assert jaccard.link_components(empty(spark)).count() == 0


def test_keep_one(spark):
    docs = spark.createDataFrame([(3, "a b c d e f g"), (1, "x y z"), (2, "A b c d e f g"), (4, None), (5, None)], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in jaccard.keep_one(docs).collect()) == [1, 2, 4, 5]
    kept = jaccard.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == 9


def test_trie_links_span_components():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 40, r.integers(1, 30)).astype(np.uint64)) for _ in range(60)]
    got = jaccard.bucket_links(sets, 60)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 60 * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b)
        parent[find(a)] = find(b)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 60 * (len(sets[a]) + len(sets[b]) - both):
                assert find(a) == find(b)


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100)] + [(1000, 1000 + k) for k in range(1, 80)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(1, 101)} | {1000 + k: 1000 for k in range(1, 80)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_shingle_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sets, frequent = jaccard.shingle_sets(docs, jaccard.Join())
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert all(r["n"] == len(shingles(texts[r["doc_id"]], 5)) for r in sets.collect())
    assert (np.diff(frequent.astype(object)) > 0).all()
    assert sets.where(F.col("n") > 0).count() > 0
