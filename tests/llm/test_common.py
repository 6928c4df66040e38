"""Hashes of words, blocks and scratch folders."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from citeweave.llm.common import blocks, scratch, store, texts, word_hashes

from .common import lower, words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAb \n\té\U0001f600　", max_size=30), min_size=1, max_size=5), st.booleans())
def test_word_hashes(found, fold):
    raw = [t.encode() for t in found]
    offsets = np.cumsum([0, *map(len, raw)])
    hashes, before = word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets, fold)
    plain = [w for t in found for w in words(lower(t) if fold else t)]
    assert len(hashes) == len(plain) and len(set(zip(plain, hashes.tolist()))) == len(set(plain)) == len(set(hashes.tolist()))
    assert np.diff(before).tolist() == [len(words(t)) for t in found]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=20)), max_size=12), st.integers(1, 40), st.integers(0, 3))
def test_blocks_keep_all_rows(found, limit, skip):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int64()), pa.array(found, pa.string())], ["k", "text"]).slice(min(skip, len(found)))
    rest, seen = found[min(skip, len(found)) :], []
    for rows, data, offsets in blocks([batch], limit):
        assert len(rows) == len(offsets) - 1 and (len(rows) == 1 or len(data) <= limit)
        seen += list(zip(rows.column("k").to_pylist(), texts(data, offsets)))
    assert [t for _, t in seen] == [t or "" for t in rest]


def test_scratch_is_shared(spark):
    assert scratch(spark).startswith(spark.conf.get("spark.checkpoint.dir")) and scratch(spark) != scratch(spark)
    frame = spark.range(10).selectExpr("id", "named_struct('a', id) AS row")
    assert store(frame).dtypes == frame.dtypes and sorted(store(frame).collect()) == sorted(frame.collect())


def test_a_stage_removes_what_the_one_before_stored(spark):
    from citeweave.llm.common import stage_scratch
    from citeweave.storage import exists

    def one(name, before=None):
        with stage_scratch(spark, name, before):
            return store(spark.range(3))

    outside, a = store(spark.range(3)), one("a")
    path = a.inputFiles()[0].rpartition("/")[0]
    again, b = one("a"), one("b", "a")
    assert not exists(spark, path) and not exists(spark, again.inputFiles()[0])
    assert b.count() == outside.count() == 3
