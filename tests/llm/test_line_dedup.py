"""Repeated line chunks against a plain version."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeweave.llm import line_dedup
from citeweave.llm.catalogue import op7_line_dedup
from citeweave.llm.line_dedup import Chunking, chunk_lines

from .common import awkward, empty, words


def plain(texts, c, avoid=frozenset()):
    """{doc_id: (text, lines removed)} by dictionaries over the bytes of chunks; those in avoid stay."""
    parts, first = {}, {}
    for d, t in texts:
        if t is None:
            continue
        lines = t.split("\n")
        parts[d] = [lines[a:b] for a, b in chunk_lines(lines, c)]
    count = {}
    for d in sorted(parts):
        for p in parts[d]:
            count[tuple(p)] = count.get(tuple(p), 0) + 1
            first.setdefault(tuple(p), d)
    out = {}
    for d, t in texts:
        if t is None:
            out[d] = (None, 0)
            continue
        kept, gone, here = [], 0, set()
        for p in parts[d]:
            key = tuple(p)
            eligible = (sum(bool(words(x)) for x in p) >= c.least_lines or sum(len(x.split()) for x in p) >= c.long_words) and len("\n".join(p).encode()) >= c.least_bytes
            if eligible and key not in avoid and count[key] > 1 and (first[key] != d or key in here):
                gone += len(p)
            else:
                kept += p
            here.add(key)
        out[d] = ("\n".join(kept), gone)
    return out


def test_query(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in op7_line_dedup(spark, sf_dir).collect()}
    assert got == plain(texts, Chunking())
    assert sum(n for _, n in got.values()) > 0


def test_random_lines(spark):
    r = random.Random(3)
    passages = [[f"passage {p} line {k} of some length {r.random()}" for k in range(12)] for p in range(5)]
    texts = []
    for d in range(80):
        lines = [f"own line {d} {k} {r.random()}" for k in range(r.randint(0, 6))]
        for _ in range(r.randint(0, 3)):
            lines += r.choice(passages) + [f"between {r.random()}"] * r.randint(0, 2)
        texts.append((d, "\n".join(lines)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == plain(texts, Chunking())
    # Most lines of a passage are gone wherever it occurs again.
    again = sum(sum(line.startswith("passage") for line in t.split("\n")) for t, _ in got.values())
    assert again < 0.45 * sum(sum(line.startswith("passage") for line in t.split("\n")) for _, t in texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=5), max_size=30), st.lists(st.text(max_size=5), max_size=10))
def test_boundaries_shift_with_content(lines, before):
    c = Chunking()
    alone = chunk_lines(lines, c)
    assert [x for a, b in alone for x in lines[a:b]] == lines
    shifted = chunk_lines(before + lines, c)
    ends = {b for _, b in alone[:-1]}
    moved = {b - len(before) for _, b in shifted[:-1]}
    # From the first boundary that both have behind a whole window, all are the same.
    both = sorted(b for b in ends & moved if b >= c.window)
    if both:
        assert {b for b in ends if b >= both[0]} == {b for b in moved if b >= both[0]}


def test_equal_hashes_with_other_bytes_stay(spark):
    """A hash of one byte: different chunks meet under it, and all that do are left alone."""
    r, c = random.Random(5), Chunking(digest_size=1)
    pool = [f"line {k} of the pool with enough bytes to count {r.random()}" for k in range(60)]
    texts = [(d, "\n".join(pool[k] for k in (r.randrange(0, 50) + j for j in range(8)) if k < 60)) for d in range(120)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    under = {}
    for _, t in texts:
        for a, b, h, raw in line_dedup._chunks(t, c)[1]:
            if h:
                under.setdefault(h, set()).add(raw)
    avoid = {tuple(raw.decode().split("\n")) for found in under.values() if len(found) > 1 for raw in found}
    alone = {tuple(raw.decode().split("\n")) for found in under.values() if len(found) == 1 for raw in found}
    assert avoid and alone
    got = {x["doc_id"]: (x["text"], x["n_removed"]) for x in line_dedup.dedup_lines(docs, c).collect()}
    assert got == plain(texts, c, avoid) != plain(texts, c)


def test_long_lines_are_passages(spark):
    """A line of 50 words goes wherever it stands again: first, last, between others, behind a blank line."""
    passage = " ".join(f"word{k}" for k in range(50))
    texts = [(1, f"own one\n{passage}\nown two"), (2, f"{passage}\nother"), (3, f"other start\n{passage}"), (4, f"some\nlines\n\n{passage}\n\nend"), (5, passage)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == {1: texts[0][1], 2: "other", 3: "other start", 4: "some\nlines\n\n\nend", 5: ""}


def test_rolling_hash_is_that_of_the_window():
    r = random.Random(1)
    lines = [f"line {r.random()}" for _ in range(300)]
    cuts = lambda x: {b for _, b in chunk_lines(x, Chunking(least_lines=1))}
    whole = cuts(lines)
    for k in range(3, 300, 7):
        # Whether a chunk ends behind line k hangs on it and the two before alone.
        assert (k + 1 in whole) == (3 in cuts(lines[k - 2 : k + 1] + ["x"]))


@pytest.mark.parametrize("verify", [True, False])
def test_awkward_rows(spark, verify):
    docs = awkward(spark)
    rows = line_dedup.dedup_lines(docs, verify=verify)
    assert rows.columns == [*docs.columns, "n_removed"] and rows.count() == docs.count()
    got = {r["doc_id"]: r for r in rows.collect()}
    assert got[2]["text"] is None and got[3]["text"] == "" and got[None]["n_removed"] == 0
    made = plain({(r["doc_id"], r["text"]) for r in docs.where("doc_id IS NOT NULL").collect()}, Chunking())
    assert {d: (r["text"], r["n_removed"]) for d, r in got.items() if d is not None} == made
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    assert line_dedup.clean_lines(docs).columns == docs.columns
