"""Phrase mining against dictionaries of all phrases, and against SQL."""

import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeweave.llm import collocations
from citeweave.llm.catalogue import OP12_SQL, op12_collocations
from citeweave.llm.collocations import Mining

from .common import awkward, empty, lower


def plain_pieces(text):
    return [w for p in re.split("[.,;:!?\\x0A-\\x0D]", lower(text)) if (w := re.findall("[^\\x20\\x09]+", p))]


def plain_counts(docs, m):
    """{lang: {phrase: count}} of all phrases, and words per language."""
    counts, n = {}, Counter()
    for lang, text in docs:
        own = counts.setdefault(lang or "und", Counter())
        for w in plain_pieces(text):
            n[lang or "und"] += len(w)
            own.update(tuple(w[i : i + k]) for k in range(1, m.longest + 1) for i in range(len(w) - k + 1))
    return counts, n


def plain_mine(docs, m):
    out, (counts, n) = [], plain_counts(docs, m)
    for lang, f in counts.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= m.least}
        ranked = []
        for p, a in kept.items():
            if any(q != p and len(q) > len(p) and 100 * b >= m.absorbs * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in kept.items()):
                continue
            score, _, l, r = min((m.scale * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[: m.top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def invented(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["É", "É", "日本", "a", "A", "\U0001f600"]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "!?"]
    docs = []
    for _ in range(n):
        text = "".join(r.choice(vocabulary[: r.choice([4, 18])]) + r.choice(marks) for _ in range(r.randint(0, 120)))
        docs.append((r.choice(["en", "de", None, "und"]), r.choice([text, text, text, None, "new york city hall " * r.randint(1, 9)])))
    return docs


@pytest.mark.parametrize(
    ("seed", "m"),
    [
        (1, Mining(least=5)),
        (2, Mining(least=5, block_bytes=200, slice_cells=64)),
        (3, Mining(least=3, block_bytes=50, slice_cells=1000, top=7, rank_rows=20)),
        (4, Mining(least=9, absorbs=50, longest=3)),
    ],
)
def test_same_as_all_phrases(spark, seed, m):
    docs = invented(seed)
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    found = collocations.mine(frame, m)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for c, t in found.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(map(tuple, found.collect())) == plain_mine(docs, m)


def test_counts_are_exact(spark):
    docs, m = invented(7), Mining(least=4, block_bytes=120, slice_cells=50)
    texts = collocations.store(collocations.text_blocks(spark.createDataFrame(docs, "lang string, text string"), m))
    found = {(r["lang"], r["phrase"]): r["n"] for r in collocations.phrase_counts(texts, m).collect()}
    counts, n = plain_counts(docs, m)
    assert found == {(lang, " ".join(p)): a for lang, f in counts.items() for p, a in f.items() if a >= m.least}
    assert {r[0]: r[1] for r in texts.groupBy("lang").sum("n_words").collect()} == {k: v for k, v in n.items() if v}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "é"]), min_size=1, max_size=60), st.integers(1, 30))
def test_parts_of_a_piece_count_once(found, limit):
    m = Mining(block_bytes=limit)
    parts = list(collocations._cut(" ".join(found).encode(), m))
    seen = Counter()
    for text, carried in parts:
        g = collocations.grams(text, "en", carried, m.longest)
        heavy = collocations.np.unique(collocations._cells(g.hashes, 3))
        phrases, places = collocations._candidates(text, g, heavy, 3)
        n = collocations.scan(text.decode(), carried, phrases)
        assert n.sum() == places
        seen.update(dict(zip(phrases, n.tolist())))
    assert +seen == Counter(" ".join(found[i : i + k]) for k in range(1, 5) for i in range(len(found) - k + 1))


def test_two_phrases_of_one_hash(spark, monkeypatch):
    docs, m = [("en", "a b. c d. " * 6)], Mining(least=5)
    monkeypatch.setattr(collocations, "mix64", lambda h: h & collocations.np.uint64(1) | collocations.np.uint64(1))
    texts = collocations.text_blocks(spark.createDataFrame(docs, "lang string, text string"), m).toArrow().to_pylist()
    g = collocations.grams(texts[0]["text"].encode(), "en", 0, 4)
    phrases, places = collocations._candidates(texts[0]["text"].encode(), g, collocations.np.unique(collocations._cells(g.hashes, 1)), 1)
    assert len(phrases) == 1 and places == 36 and collocations.scan(texts[0]["text"], 0, phrases).sum() != places


def test_large_products(spark):
    big = 3 * 10**13
    rows = [("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, 2 * big), ("en", "a b c", 3, big), ("en", "c", 1, big), ("en", "b c", 2, big)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, n bigint")
    scored = collocations.weakest_cuts(counts)
    assert {r["phrase"]: (r["score"], r["l"], r["r"]) for r in scored.collect()} == {"a b": (2000000 // 3, big, 2 * big), "b c": (2000000 // 3, 2 * big, big), "a b c": (1000000, big, big)}
    assert [r["phrase"] for r in collocations.not_absorbed(scored, counts).collect()] == ["a b c"]


def test_awkward_rows(spark):
    docs, m = awkward(spark), Mining(least=3)
    rows = [(x["lang"], x["text"]) for x in docs.collect()]
    assert sorted(map(tuple, collocations.mine(docs, m).collect())) == plain_mine(rows, m)
    assert collocations.mine(empty(spark), m).count() == 0
    with pytest.raises(ValueError):
        collocations.mine(docs, Mining(least=256))


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{Path(sf_dir)}/documents.parquet'")
    frame, other = op12_collocations(spark, sf_dir), con.sql(OP12_SQL)
    assert frame.columns == other.columns and sorted(map(tuple, frame.collect())) == sorted(other.fetchall())
