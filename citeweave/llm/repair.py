"""Token-id shards compressed by a Re-Pair grammar, with random-access decoding.

A shard holds the ids of consecutive documents. In each round its most frequent adjacent pairs become nonterminals at once:
those at least half as often as the first, and more until SHARE of all places are theirs (of those that overlap, the left
one goes), each used twice or more. Rounds go on until no pair occurs twice without overlap. Rules of a round use only
symbols of earlier ones.
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

from citeweave.llm.common import blocks, scratch
from citeweave.llm.tokens import ENCODED_BYTES, Encoder

SHARD_TOKENS = 1 << 18
#: Text bytes of a task that writes shards.
TASK_BYTES = 1 << 30
#: Of the places in a sequence, what one round aims at; less only means more rounds.
SHARE = 1 / 12
#: Symbols of a sequence between two stored positions.
STRIDE = 256


@dataclass
class Grammar:
    base: int
    left: np.ndarray
    right: np.ndarray
    #: How many ids each rule stands for.
    lengths: np.ndarray
    sequence: np.ndarray
    #: How many ids come before every STRIDE-th symbol of the sequence.
    positions: np.ndarray


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys (not negative), and the number of each."""
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits < 64:  # key and place in one integer sort faster than places by key
        both = np.sort((keys.astype(np.int64) << bits) | np.arange(len(keys)))
        ordered, by = both >> bits, both & ((1 << bits) - 1)
    else:
        by = np.argsort(keys, kind="stable")
        ordered = keys[by]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)  # what numpy counts and looks up by without a copy
    number[by] = np.cumsum(new) - 1
    return ordered[new], number


def _least(n: np.ndarray, total: int) -> int:
    """The count from which on pairs are taken, of those that have two places or more; total: of all pairs' places."""
    by_count = np.bincount(n)
    places = np.cumsum((by_count * np.arange(len(by_count)))[::-1])[::-1]
    enough = np.flatnonzero(places[2:] >= SHARE * total)
    return max(2, min((len(by_count) - 1) // 2, int(enough[-1]) + 2 if len(enough) else 2))


def _numbers(kept: np.ndarray, n: int) -> np.ndarray:
    """For each of n old numbers that is kept its new one; kept ones are ascending and stay so."""
    new = np.empty(n, np.int64)
    new[kept] = np.arange(len(kept))
    return new


def _spaced(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring positions, every other from the first on."""
    new = np.ones(len(hit), bool)
    new[1:] = hit[1:] != hit[:-1] + 1
    first = hit[np.maximum.accumulate(np.where(new, np.arange(len(hit)), 0))]
    return hit[(hit - first) % 2 == 0]


def _chosen(pairs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of wanted pairs that do not overlap, of pairs that have two such places or more; the pair at each, and these pairs."""
    hit = _spaced(np.flatnonzero(wanted.take(pairs)))
    of = pairs.take(hit)
    twice = np.bincount(of, minlength=len(wanted)) > 1
    stay = np.flatnonzero(twice.take(of))
    return hit.take(stay), of.take(stay), np.flatnonzero(twice)


def compress(ids: np.ndarray) -> Grammar:
    """The number of each adjacent pair is kept beside it: only pairs that a round makes are looked up, as no earlier pair equals them."""
    base = int(ids.max()) + 1 if len(ids) else 1
    s = ids.astype(np.int32)
    # A rule replaces two symbols twice, so there are fewer rules than ids.
    bits = (base + len(ids)).bit_length()
    low = (1 << bits) - 1
    keys, pairs = _dense((s[:-1].astype(np.int64) << bits) | s[1:])
    rules, n_rules = [], 0
    while len(s) > 1:
        n = np.bincount(pairs, minlength=len(keys))
        if len(keys) > 2 * len(pairs) + 1024:  # numbers that no place has any more are left out
            seen = np.flatnonzero(n)
            pairs, keys, n = _numbers(seen, len(keys)).take(pairs), keys[seen], n[seen]
        often = n.take(np.flatnonzero(n > 1))
        if not len(often):
            break
        hit, of, used = _chosen(pairs, n >= _least(often, len(pairs)))
        if not len(hit):  # all places of each pair overlap those of others: then pairs of different symbols, one alone, or of equal ones
            twice, equal = n > 1, (keys >> bits) == (keys & low)
            other = np.flatnonzero(twice & ~equal)
            one = np.zeros(len(keys), bool)
            one[other[np.argmax(n[other])] if len(other) else np.flatnonzero(twice & equal)] = True
            hit, of, used = _chosen(pairs, one)
            if not len(hit):
                break
        rules.append(keys[used])
        s[hit] = base + n_rules + _numbers(used, len(keys)).take(of)
        n_rules += len(used)
        keep = np.ones(len(s), bool)
        keep[hit + 1] = False
        keep = np.flatnonzero(keep)
        s = s.take(keep)
        made = hit - np.arange(len(hit))
        fresh = np.stack([made - 1, made], 1).ravel()  # ascending, with repeats side by side
        fresh = fresh[(np.diff(fresh, prepend=-1) > 0) & (fresh < len(s) - 1)]
        values, number = _dense((s[fresh].astype(np.int64) << bits) | s[fresh + 1])
        pairs = pairs.take(keep[: len(s) - 1])
        pairs[fresh] = len(keys) + number
        keys = np.concatenate([keys, values])
    rule = np.concatenate(rules) if rules else np.zeros(0, np.int64)
    left, right = rule >> bits, rule & low
    lengths, a = np.ones(base + len(rule), np.int64), base
    for r in rules:
        lengths[a : a + len(r)] = lengths[r >> bits] + lengths[r & low]
        a += len(r)
    before = np.cumsum(lengths[s]) - lengths[s]
    s = s.astype(np.int64)
    return Grammar(base, left, right, lengths[base:], s, before[::STRIDE].copy())


def decode(g: Grammar) -> np.ndarray:
    """All ids. Every pass puts ids in their places and parts rules into their two sides, so each is touched once."""
    size = np.concatenate([np.ones(g.base, np.int64), g.lengths])
    s, own = g.sequence, size.take(g.sequence)
    at = np.cumsum(own) - own
    out = np.empty(int(own.sum()), np.uint32)
    while len(s):
        known, rule = np.flatnonzero(s < g.base), np.flatnonzero(s >= g.base)
        out[at.take(known)] = s.take(known)
        at, rule = at.take(rule), s.take(rule) - g.base
        left, right = g.left.take(rule), g.right.take(rule)
        s, at = np.concatenate([left, right]), np.concatenate([at, at + size.take(left)])
    return out


def decode_range(g: Grammar, start: int, stop: int, count: list[int] | None = None) -> np.ndarray:
    """ids[start:stop]. Reads the sequence from the stored position before start, and expands a rule only where it covers
    a wanted id; count gets the number of rules that each pass expands."""
    if stop <= start or not len(g.sequence):
        return np.zeros(0, np.uint32)
    size = lambda x: np.where(x < g.base, 1, g.lengths[np.maximum(x - g.base, 0)] if len(g.lengths) else 1)
    a = max(int(np.searchsorted(g.positions, start, "right")) - 1, 0)
    b = int(np.searchsorted(g.positions, stop, "left"))
    s = g.sequence[a * STRIDE : b * STRIDE]
    at = g.positions[a] + np.cumsum(size(s)) - size(s)
    while True:
        within = (at < stop) & (at + size(s) > start)
        s, at = s[within], at[within]
        rule = s >= g.base
        if not rule.any():
            return s.astype(np.uint32)
        if count is not None:
            count.append(int(rule.sum()))
        left, right = g.left[s[rule] - g.base], g.right[s[rule] - g.base]
        s, at = np.concatenate([s[~rule], left, right]), np.concatenate([at[~rule], at[rule], at[rule] + size(left)])
        by = np.argsort(at, kind="stable")
        s, at = s[by], at[by]


def _pack(x: np.ndarray) -> bytes:
    """The width of an id in bytes, then little-endian ids."""
    wide = len(x) and int(x.max()) > 0xFFFF
    return bytes([4 if wide else 2]) + x.astype("<u4" if wide else "<u2").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<u4" if b[0] == 4 else "<u2", offset=1).astype(np.int64)


SHARD = "task int, shard int, start bigint, n_tokens bigint, doc_ids binary, doc_nulls binary, counts binary, base bigint, left binary, right binary, lengths binary, sequence binary, positions binary"


def to_row(task: int, shard: int, start: int, doc_ids: list, counts: list[int], ids: np.ndarray) -> tuple:
    g = compress(ids)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return (task, shard, start, len(ids), known.tobytes(), nulls.tobytes(), np.array(counts, "<i8").tobytes(), g.base,
            *map(_pack, (g.left, g.right, g.lengths, g.sequence, g.positions)))


def grammar_of(row: dict) -> Grammar:
    return Grammar(row["base"], *(_unpack(row[k]) for k in ("left", "right", "lengths", "sequence", "positions")))


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encodes whole texts and writes shards, in ascending doc_id order over tasks and shards.

    Documents are dealt by ranges of doc_id, then of a hash of the text, so that null ids or many rows of one id are
    parted too. Tasks are as many as the session has shuffle partitions (fewer, where the planner joins small ones), and
    more where these would read over TASK_BYTES of text each. They follow each other as their ids do; a task writes many
    shards and holds one. A document longer than a shard is a shard of its own with those before it. Null texts hold the
    end id alone. Rows of one doc_id lie side by side, equal rows as such; null ids come first. Only doc_id and text are
    read, so other columns may have any name. An empty table gives no shards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder.get(tokenizer, True), TaskContext.get().partitionId()
        names = [f.split(" ")[0] for f in SHARD.split(", ")]
        ids, doc_ids, size, shard, start = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = to_row(task, shard, start, doc_ids, [len(x) for x in ids], np.concatenate(ids))
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=schema)

        schema = pa.schema([(n, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (f.split(" ") for f in SHARD.split(", "))])
        for rows, data, offsets in blocks(batches, ENCODED_BYTES):
            for d, x in zip(rows.column("doc_id").to_pylist(), encoder.documents(data, offsets, end_id)):
                ids.append(x)
                doc_ids.append(d)
                size += len(ids[-1])
                if size >= SHARD_TOKENS:
                    yield close()
                    ids, doc_ids, start, size, shard = [], [], start + size, 0, shard + 1
        if ids:
            yield close()

    order = ["doc_id", F.xxhash64("text")]
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = -(-size // TASK_BYTES)
    few = tasks <= int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = docs.select("doc_id", "text")
    dealt = (chosen.repartitionByRange(*order) if few else chosen.repartitionByRange(tasks, *order)).sortWithinPartitions(*order, "text")
    dealt.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    A shard knows its start within its task; one row a task (never a row a document) gives the ids before each task.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    totals = sorted((r["task"], r["n"]) for r in shards.groupBy("task").agg(F.sum("n_tokens").alias("n")).collect())
    before, total = {}, 0
    for task, n in totals:
        before[task] = total
        total += n
    shared = spark.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = decode(grammar_of(row)).astype("<u4").tobytes()
                counts = np.frombuffer(row["counts"], "<i8")
                ends = np.cumsum(counts)
                at = (ends - counts).tolist()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, ends.tolist())]
                ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["doc_nulls"], np.uint8) > 0)
                start = ends - counts + row["start"] + shared.value[row["task"]]
                yield pa.RecordBatch.from_arrays([ids, pa.array(start), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes documents as shards in the shared folder and describes each from the files; an empty table gives no rows."""
    path = scratch(docs.sparkSession)
    write_shards(docs, path, tokenizer)
    return read_shards(docs.sparkSession, path)
