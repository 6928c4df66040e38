"""The five stages against each other's plain versions on a small table."""

import corpus_pipeline
import public_tokenizers

from citeweave.llm import quality
from citeweave.llm.line_dedup import Chunking

from .common import awkward, empty, plain_components
from .test_line_dedup import plain
from .test_tokens_and_shards import check_pieces

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_and_their_effects(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = (before, docs)
        assert k == 4 or docs.columns == before.columns
    text = lambda frame: [(r["doc_id"], r["text"]) for r in frame.collect()]
    before, after = seen["quality rules"]
    kept = {r["doc_id"] for r in quality.judge(before).where("kept").collect()}
    assert sorted(text(after)) == sorted(x for x in text(before) if x[0] in kept) and 0 < len(kept) < before.count()
    before, after = seen["line dedup"]
    assert dict(text(after)) == {d: t for d, (t, _) in plain(text(before), Chunking()).items()}
    before, after = seen["n-gram Jaccard join"]
    components = plain_components(text(before), 5, 80)
    assert {d for d, _ in text(after)} == {d for d, (_, c) in components.items() if c == d} and after.count() < before.count()
    before, after = seen["mixing"]
    assert set(text(after)) == set(text(before)) and after.count() >= before.count()
    before, after = seen["packing"]
    times = {}
    for d, _ in text(before):
        times[d] = times.get(d, 0) + 1
    once = [r for r in after.collect() if times[r["doc_id"]] == 1]
    assert sum(r["length"] for r in after.collect()) == sum(r["doc_tokens"] * times[r["doc_id"]] for r in after.select("doc_id", "doc_tokens").distinct().collect())
    assert {r["doc_id"] for r in once} == {d for d, n in times.items() if n == 1}
    assert public_tokenizers and check_pieces


def test_run_gives_the_last_stage(spark, sf_dir):
    made = corpus_pipeline.run(spark, sf_dir)
    assert made.columns[:5] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] and made.count() > 0


def test_awkward_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, "")
            rows = made.count()
            assert rows or not docs.count() or name == "quality rules"
