"""Packing by lexical retrieval: a sharded BM25 index returns unused neighbours that fill each seed's window.

Document frequencies and lengths are those of the whole table. Shards follow the texts: documents lie in the order of
their rarest terms (of those that another document has), and each run of shard_docs is one shard of the index.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import blocks, store
from citeweave.llm.tokens import Encoder, ranges

#: Text bytes that are encoded at once, beside a worker's counts of terms.
ENCODED_BYTES = 1 << 21
#: Words that a worker remembers meanwhile.
CACHE = 400_000


@dataclass(frozen=True)
class Packing:
    window: int = 4096
    #: Documents of a shard; it holds less than a window of each, so its size is bounded.
    shard_docs: int = 1024
    k1: float = 1.2
    b: float = 0.75


@dataclass(frozen=True)
class Corpus:
    """Of all pieces to be packed: how many have each token id, how many there are, and their mean length."""

    df: np.ndarray
    pieces: int
    mean: float

    def idf(self, term: np.ndarray) -> np.ndarray:
        df = self.df[term]
        return np.log(1 + (self.pieces - df + 0.5) / (df + 0.5))


def _distinct(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(piece << 32 | term) of every term of every piece, ascending, and how often it is there."""
    n = np.array([len(x) for x in pieces], np.int64)
    keys = np.sort((np.repeat(np.arange(len(pieces), dtype=np.int64), n) << 32) | np.concatenate(pieces).astype(np.int64))
    at = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[at], np.diff(at, append=len(keys))


def corpus_of(pieces: list[np.ndarray]) -> Corpus:
    """The pieces of one shard as a corpus of their own."""
    return Corpus(np.bincount(_distinct(pieces)[0] & 0xFFFFFFFF), len(pieces), max(sum(map(len, pieces)) / len(pieces), 1.0))


def weights(pieces: list[np.ndarray], c: Corpus, p: Packing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, term, BM25 weight) of every term of every piece, by piece and term."""
    n = np.array([len(x) for x in pieces])
    keys, tf = _distinct(pieces)
    doc, term = keys >> 32, keys & 0xFFFFFFFF
    norm = p.k1 * (1 - p.b + p.b * n / c.mean)
    return doc, term, c.idf(term) * tf * (p.k1 + 1) / (tf + norm[doc])


class Bm25:
    """Postings of token ids over the pieces of one shard."""

    def __init__(self, pieces: list[np.ndarray], p: Packing, c: Corpus):
        doc, self.term, weight = weights(pieces, c, p)
        self.size = len(pieces)
        self.before = np.searchsorted(doc, np.arange(len(pieces) + 1))
        by_term = np.argsort(self.term, kind="stable")
        self.doc, self.weight = doc[by_term], weight[by_term]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.term))])

    def neighbours(self, piece: int) -> np.ndarray:
        """Pieces that share a term with this one, best first; ties by position."""
        terms = self.term[self.before[piece] : self.before[piece + 1]]
        at = ranges(self.first[terms], self.first[terms + 1] - self.first[terms])
        score = np.bincount(self.doc[at], self.weight[at], self.size)
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def fill(tails: list[np.ndarray], p: Packing, c: Corpus | None = None, own: list | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (tail, from, to). All but the last ones are full; these have powers of two.

    Seeds are the longest unused tails; a neighbour that does not fit is cut, its rest stays unused. A neighbour of the
    same document (own: their ids), as of another pass of a mixture, is left for another window.
    """
    order = sorted((k for k, x in enumerate(tails) if len(x)), key=lambda k: (-len(tails[k]), k))
    if not order:
        return []
    own = list(range(len(tails))) if own is None else own
    index = Bm25(tails, p, c or corpus_of(tails))
    done, size = [0] * len(tails), [len(x) for x in tails]
    windows, current, room, held = [], [], p.window, {}

    def put(k: int) -> None:
        nonlocal room
        n = min(room, size[k] - done[k])
        if n and held.setdefault(own[k], k) == k:
            current.append((k, done[k], done[k] + n))
            done[k] += n
            room -= n

    for seed in order:
        while done[seed] < size[seed]:
            before = done[seed]
            put(seed)
            for k in index.neighbours(seed).tolist() if room else ():
                put(k)
                if not room:
                    break
            if not room:
                windows.append(current)
                current, room, held = [], p.window, {}
            elif done[seed] == before:  # another pass of it is in the window that is being filled
                held = {}
            else:
                break
    # What is left is shorter than a window: cut into powers of two, so that it needs no padding.
    while current:
        left = sum(b - a for _, a, b in current)
        size, head, rest = 1 << (left.bit_length() - 1), [], []
        for k, a, b in current:
            cut = min(b, a + size)
            if cut > a:
                head.append((k, a, cut))
                size -= cut - a
            if cut < b:
                rest.append((k, cut, b))
        windows.append(head)
        current = rest
    return windows


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
ENCODED = "doc_id bigint, n bigint, whole binary, tail binary, term bigint, df bigint"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tail(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2") if len(raw) % 2 == 0 else np.frombuffer(raw, "<u4", offset=1)


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """A row a document: its checksums of whole windows, and its tail; and rows (term, df) that a task adds up: of tails
    with a token id, of tails at -1 and of their ids at -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.get(tokenizer, False, CACHE)
        df = np.zeros(len(encoder.edge), np.int64)
        n_tails, n_ids = 0, 0
        for rows, data, offsets in blocks(batches, ENCODED_BYTES):
            ids = encoder.documents(data, offsets, end_id)
            n = np.array([len(x) for x in ids], np.int64)
            whole = [np.array([_crc(x[a : a + window]) for a in range(0, len(x) - window + 1, window)], "<u4").tobytes() for x in ids]
            tails = [x[len(x) // window * window :] for x in ids]
            df += np.bincount(_distinct(tails)[0] & 0xFFFFFFFF, minlength=len(df))
            n_tails, n_ids = n_tails + sum(1 for x in tails if len(x)), n_ids + sum(map(len, tails))
            small = [t.astype("<u2").tobytes() if not len(t) or t.max() <= 0xFFFF else b"\0" + t.astype("<u4").tobytes() for t in tails]
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n), pa.array(whole, pa.binary()), pa.array(small, pa.binary()), none, none], names)
        seen = np.flatnonzero(df)
        term, count = np.concatenate([[-2, -1], seen]), np.concatenate([[n_ids, n_tails], df[seen]])
        none = pa.nulls(len(term), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(term), pa.binary()), pa.nulls(len(term), pa.binary()), pa.array(term), pa.array(count)], names)

    names = [f.split(" ")[0] for f in ENCODED.split(", ")]
    return store(docs.select("doc_id", "text").mapInArrow(run, ENCODED))


def _corpus(encoded: DataFrame) -> Corpus:
    """From one row a token id at most, whatever the size of the table."""
    rows = encoded.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")).toPandas().set_index("term")["df"]
    seen = rows[rows.index >= 0]
    df = np.zeros(int(seen.index.max()) + 1 if len(seen) else 1, np.int64)
    df[seen.index.to_numpy(np.int64)] = seen.to_numpy(np.int64)
    pieces = int(rows.get(-1, 0))
    return Corpus(df, pieces, max(int(rows.get(-2, 0)) / max(pieces, 1), 1.0))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, p: Packing = Packing()) -> DataFrame:
    """One row per piece. Whole windows of a document are sequences of their own; its tail is packed in its shard.

    Null and empty texts hold the end id alone. Very long texts only add whole windows. Rows of a repeated doc_id are
    packed each, in different windows where others are left. Documents are dealt by ranges of (rarest term, next one,
    hash), so a term that many share is parted; ties lie in the order of doc_id and text. An empty table gives no rows.
    Only doc_id and text are read, so other columns may have any name.
    """
    window = p.window
    encoded = _encoded(docs, tokenizer, end_id, window)
    shared = docs.sparkSession.sparkContext.broadcast(_corpus(encoded))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the two rarest terms of each tail that other tails have too; -1 where there are none."""
        for batch in (b.slice(a, p.shard_docs) for b in batches for a in range(0, len(b), p.shard_docs)):
            tails = list(map(_tail, batch.column("tail").to_pylist()))
            top = np.full((len(tails), 2), -1, np.int32)
            if sum(map(len, tails)):
                keys = _distinct(tails)[0]
                doc, term = keys >> 32, keys & 0xFFFFFFFF
                df = shared.value.df[term]
                doc, term, df = doc[df > 1], term[df > 1], df[df > 1]
                by = np.lexsort((term, df, doc))
                first = np.searchsorted(doc, np.arange(len(tails) + 1))
                for k in (0, 1):
                    has = first[:-1] + k < first[1:]
                    top[has, k] = term[by[first[:-1][has] + k]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(top[:, 0].copy()), pa.array(top[:, 1].copy())], [*batch.schema.names, "t1", "t2"])

    def pack(table: pa.Table, number: int) -> tuple[pa.RecordBatch, int]:
        doc_ids, ns = table.column("doc_id").to_pylist(), table.column("n").to_pylist()
        tails, out = list(map(_tail, table.column("tail").to_pylist())), []
        for d, n, whole in zip(doc_ids, ns, table.column("whole").to_pylist()):
            for k, crc in enumerate(np.frombuffer(whole, "<u4").tolist()):
                out.append((d, k * window, window, crc, n, number, 0))
                number += 1
        for pieces in fill(tails, p, shared.value, [(k,) if d is None else d for k, d in enumerate(doc_ids)]):
            offset = 0
            for k, a, b in pieces:
                out.append((doc_ids[k], ns[k] // window * window + a, b - a, _crc(tails[k][a:b]), ns[k], number, offset))
                offset += b - a
            number += 1
        names = [f.split(" ")[0] for f in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names), number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], TaskContext.get().partitionId() << 36
        for batch in batches:
            while len(batch):
                part = batch.slice(0, p.shard_docs - sum(map(len, held)))
                batch = batch.slice(len(part))
                held.append(part)
                if sum(map(len, held)) == p.shard_docs:
                    made, number = pack(pa.Table.from_batches(held), number)
                    held = []
                    yield made
        if held:
            yield pack(pa.Table.from_batches(held), number)[0]

    columns = "doc_id bigint, n bigint, whole binary, tail binary"
    keyed = encoded.where("term IS NULL").select("doc_id", "n", "whole", "tail").mapInArrow(rarest, columns + ", t1 int, t2 int")
    hashed = keyed.withColumn("h", F.xxhash64("doc_id", "tail"))
    dealt = hashed.repartitionByRange("t1", "t2", "h").sortWithinPartitions("t1", "t2", "h", "doc_id", "n", "tail")
    return dealt.select("doc_id", "n", "whole", "tail").mapInArrow(run, PIECES)
