"""Token ids equal those of whole texts; shards and packs round-trip."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from citeweave.llm import packing, repair
from citeweave.llm.catalogue import op3_token_id_output, op9_retrieval_packing
from citeweave.llm.tokens import Encoder

from .common import awkward, empty

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXT = st.lists(st.sampled_from([" ", "  ", "\n", "\t", " ", "　", "'s", "'LL", "a", "Word", "ß", "É", "é", "Σ", "ΑΣ", "12", "x1", "x,", "y.", "z?!", "Q;", "!", ",", "...", "<|endoftext|>", "<|startoftext|>", "\U0001f600", "中", "\0", "\r\n", "ﬁ", "İ"]), max_size=14).map("".join)


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(TEXT, st.text(max_size=20)), min_size=1, max_size=4))
def test_pieces_encode_as_whole_texts(found):
    for path, keep in ((BYTE, True), (WORD, False)):
        whole = [e.ids for e in _tokenizer(path).encode_batch(found, add_special_tokens=False)]
        raw = [t.encode() for t in found]
        made = Encoder.get(path, keep).documents(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 7)
        assert [x.tolist() for x in made] == [x + [7] for x in whole]


_open = {}


def _tokenizer(path):
    if path not in _open:
        _open[path] = Tokenizer.from_file(path)
    return _open[path]


def plain_ids(path, text, end):
    return _tokenizer(path).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(0, 60_000), st.data())
def test_grammar_round_trip(small, offset, data):
    ids = np.array(small * 8, np.uint32) + np.uint32(offset)
    g = repair.compress(ids)
    row = dict(zip([f.split(" ")[0] for f in repair.SHARD.split(", ")], repair.to_row(0, 0, 0, [1], [len(ids)], ids)))
    stored = repair.grammar_of(row)
    assert (repair.decode(g) == ids).all() and (repair.decode(stored) == ids).all() and len(repair.decode(g)) == len(ids)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert repair.decode_range(stored, a, b).tolist() == ids[a:b].tolist()
    assert (g.lengths >= 2).all()
    assert not repeated_pairs(g.sequence)


def repeated_pairs(sequence):
    """Pairs with two places or more that do not overlap."""
    last, n = {}, {}
    for k, pair in enumerate(zip(sequence.tolist(), sequence.tolist()[1:])):
        if last.get(pair, -2) < k - 1:
            last[pair], n[pair] = k, n.get(pair, 0) + 1
    return [pair for pair, k in n.items() if k > 1]


def test_decoding_touches_each_rule_once(monkeypatch):
    """op3: work follows the ids, not the ids times the depth of the rules."""
    ids = np.concatenate([np.arange(3, 50_000, dtype=np.uint32), np.tile(np.arange(3, dtype=np.uint32), 1 << 9)])
    g = repair.compress(ids)
    handled, find = [], np.flatnonzero
    monkeypatch.setattr(repair.np, "flatnonzero", lambda x: handled.append(len(x)) or find(x))
    assert (repair.decode(g) == ids).all()
    assert sum(handled) < 5 * len(ids)


def test_words_are_looked_up_once_a_block(monkeypatch):
    """op3: a word with other marks behind it is the same word."""
    encoder, asked = Encoder(BYTE, True), []
    monkeypatch.setattr(encoder.words, "find", lambda words, find=encoder.words.find: asked.extend(words) or find(words))
    text = "so word word, word. word! (word) wordy".encode()
    ids = encoder.documents(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 7)[0]
    assert ids.tolist() == plain_ids(BYTE, text.decode(), 7)
    assert asked.count("word") == 1 and len(asked) == len(set(asked))


def test_every_rule_is_used_twice():
    ids = np.random.default_rng(5).integers(0, 9, 5000).astype(np.uint32)
    g = repair.compress(ids)
    used = np.bincount(np.concatenate([g.sequence, g.left, g.right]))
    # Later rounds may replace a pair that holds a rule, so a rule's uses are at least once in a rule or in the sequence.
    assert len(g.left) and (used[g.base :] >= 1).all()
    assert not repeated_pairs(g.sequence)


def test_random_access_expands_only_what_covers_the_range():
    ids = np.tile(np.random.default_rng(5).integers(0, 900, 3000).astype(np.uint32), 16)
    g = repair.compress(ids)
    for start in (0, 17, 20_000, len(ids) - 5):
        expanded = []
        assert repair.decode_range(g, start, start + 5, expanded).tolist() == ids[start : start + 5].tolist()
        # Of each level of the grammar, the few rules that cover five ids; not the rules of the shard.
        assert all(n <= 6 for n in expanded) and sum(expanded) < 6 * 40 < len(g.left)


def test_grammar_shortens_repeats():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    g = repair.compress(ids)
    assert len(g.sequence) < len(ids) / 50 and len(g.left) > 0


def check_shards(rows, texts):
    start = 0
    for r, (d, t) in zip(rows, texts, strict=True):
        ids = plain_ids(BYTE, t, 0)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, start, len(ids), crc(ids))
        start += len(ids)


def test_token_query(spark, sf_dir):
    texts = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    check_shards(sorted(op3_token_id_output(spark, sf_dir).collect()), texts)


def test_small_shards_and_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_TOKENS", 5000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_shards(sorted(repair.encode_documents(docs, BYTE).collect()), sorted((r["doc_id"], r["text"]) for r in docs.collect()))


def test_tasks_follow_bytes_and_part_null_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "TASK_BYTES", 400)
    rows = [(None if k % 2 else k // 4, f"text number {k % 61} " * 3) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = f"file://{tmp_path}/shards"
    repair.write_shards(docs, path, BYTE)
    shards = spark.read.schema(repair.SHARD).parquet(path)
    assert shards.select("task").distinct().count() > 12
    null_tasks = {r["task"] for r in shards.collect() if any(r["doc_nulls"])}
    assert len(null_tasks) > 4
    got = sorted(repair.read_shards(spark, path).collect(), key=lambda r: r["start"])
    key = lambda d: (d is not None, d or 0)
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=key)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    told = lambda d, ids: (key(d), len(ids), crc(ids))
    assert sorted((key(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(told(d, plain_ids(BYTE, t, 0)) for d, t in rows)


def test_awkward_shards(spark):
    docs = awkward(spark)
    rows = sorted(repair.encode_documents(docs, BYTE).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 2, 3, 4, 5, 7, 8]
    check_shards(rows, [(r["doc_id"], r["text"]) for r in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))])
    assert repair.encode_documents(empty(spark), BYTE).count() == 0


def check_pieces(rows, texts):
    """texts: {doc_id: text}. Pieces cover every id once, sequences are gapless and full."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for d, t in texts.items():
        ids, at = plain_ids(WORD, t, 2), 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
        sizes.append(at)
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes)
    assert padding <= 0.02 * sum(sizes)


def test_packing_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_pieces(op9_retrieval_packing(spark, sf_dir).collect(), texts)


def test_awkward_packing(spark):
    docs = awkward(spark).where("doc_id IS NULL OR doc_id <> 1")
    check_pieces(packing.pack_documents(docs, WORD).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})
    twice = packing.pack_documents(awkward(spark).where("doc_id = 1"), WORD).collect()
    assert sum(r["length"] for r in twice) == 2 * twice[0]["doc_tokens"]
    assert packing.pack_documents(empty(spark), WORD).count() == 0


def test_bm25_ranks_by_shared_rare_terms():
    tails = [np.array(x, np.uint32) for x in ([1, 2, 3, 4], [9, 9, 9, 1], [2, 3, 4, 5], [7, 8], [1, 9])]
    index = packing.Bm25(tails, packing.Packing(), packing.corpus_of(tails))
    order = index.neighbours(0).tolist()
    assert order[0] == 0 and order[1] == 2 and 3 not in order

    def plain(q, d):
        n, mean = [len(t) for t in tails], np.mean([len(t) for t in tails])
        score = 0.0
        for t in set(tails[q].tolist()):
            df, tf = sum(t in x for x in tails), (tails[d] == t).sum()
            score += np.log(1 + (len(tails) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n[d] / mean))
        return score

    assert order == sorted((d for d in range(5) if plain(0, d) > 0), key=lambda d: (-plain(0, d), d))


def test_neighbours_share_windows():
    a = [np.arange(100, 1100, dtype=np.uint32) for _ in range(4)]
    b = [np.arange(5000, 6000, dtype=np.uint32) for _ in range(4)]
    mixed = [x for pair in zip(a, b) for x in pair]
    windows = packing.fill(mixed, packing.Packing(window=4000))
    assert [{k % 2 for k, _, _ in w} for w in windows] == [{0}, {1}]


def test_passes_of_a_document_lie_in_different_windows():
    tails = [np.arange(100, 1100, dtype=np.uint32)] * 2 + [np.arange(3000 + 1000 * k, 4000 + 1000 * k, dtype=np.uint32) for k in range(2)] + [np.arange(100, 2100, dtype=np.uint32)] * 2
    windows = packing.fill(tails, packing.Packing(window=3000), own=[1, 1, 2, 3, 4, 4])
    for w in windows:
        own = [[1, 1, 2, 3, 4, 4][k] for k, _, _ in w]
        assert len(set(own)) == len(own)


def test_like_texts_meet_in_one_shard_of_a_large_table(spark):
    """Two texts on each of many topics, far apart by doc_id: nearly all partners share a sequence."""
    rng = np.random.default_rng(1)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(40)] for _ in range(600)]
    rows = [(k + 1000 * half, " ".join(rng.choice(words[k], 700))) for half in (0, 1) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = packing.pack_documents(docs, WORD, p=packing.Packing(shard_docs=64)).collect()
    of = {}
    for r in found:
        of.setdefault(r["doc_id"], set()).add(r["sequence_id"])
    assert sum(bool(of[k] & of[k + 1000]) for k in range(600)) > 450
