"""N-gram Jaccard join by prefix trees.

Every document is the set of its k-word shingles, in one global order: shingles that many documents share come last,
the others by hash. Documents that link share one of the first n - ceil(t n) + 1 shingles of that order, so they
meet in the bucket of such a shingle. In a bucket, a trie of the ordered sets is walked with each set: partial overlaps
are shared along common beginnings, and subtrees go by the overlap that the remaining lengths still allow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import blocks, mix64, store, windows, word_hashes
from citeweave.llm.graph import components

#: Shingles that are put last, at most (8 MB broadcast). Which these are changes the work, never the links.
MAX_FREQUENT = 1 << 20
#: Shingles in a bucket, where a set counts for LEAST_WEIGHT at least, so that its pairs are bounded too (2^25). Larger
#: buckets are dealt by pairs of shares, which together hold every pair.
BUCKET_SHINGLES = 1 << 19
LEAST_WEIGHT = 64
SKETCH_BITS = 512


@dataclass(frozen=True)
class Join:
    k: int = 5
    percent: int = 80


def needed(n: np.ndarray | int, percent: int):
    """Least overlap of a set of n with any set that it links to: ceil(t n)."""
    return -(-n * percent // 100)


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each document, ascending; of its whole word sequence where it has fewer than k."""
    words, before = word_hashes(data, offsets, True)
    at = before.tolist()
    for a, b in zip(at, at[1:]):
        w = words[a:b]
        yield np.unique(windows(w, min(k, len(w)))) if len(w) else w


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    if not len(s):
        return 0, 0
    with np.errstate(over="ignore"):
        one = mix64(np.bitwise_xor.reduce(mix64(s + np.uint64(0x1234567))) + np.uint64(len(s)))
        two = mix64(mix64(s ^ np.uint64(0x5DEECE66D2545F49)).sum(dtype=np.uint64))
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _sketch(s: np.ndarray) -> bytes:
    """Parities of the set's hashes in cells, at least SKETCH_BITS and a power of two that grows with the set."""
    cells = SKETCH_BITS
    while cells < len(s) // 2:
        cells *= 2
    odd = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _ordered(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The set in the global order: shingles that are not frequent first."""
    if not len(frequent) or not len(s):
        return s
    last = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
    return np.concatenate([s[~last], s[last]])


def shingle_sets(docs: DataFrame, join: Join) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, d1, d2, sketch) of every row, and the frequent shingles.

    A task counts shingles over its documents, in groups of 4096; those in three or more of a group add up over all tasks.
    Two sketches differ in no more bits than their sets in members; the halves of a sketch give, by exclusive or, that of
    half its size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def frequent() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n > 2
            held.clear()
            v = values[often].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.nulls(len(v), pa.int64()), pa.array(n[often].astype(np.int64)), pa.array(v), pa.nulls(len(v), pa.int64()), pa.nulls(len(v), pa.binary())], names)

        names = ["doc_id", "n", "d1", "d2", "sketch"]
        size = 0
        for rows, data, offsets in blocks(batches):
            sets = list(_sets(data, offsets, join.k))
            d = np.array([_digest(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.array([len(s) for s in sets], np.int64)), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array(list(map(_sketch, sets)), pa.binary())], names)
            held += sets
            size += sum(map(len, sets))
            if len(held) >= 4096 or size > 4_000_000:
                yield frequent()
                size = 0
        if held:
            yield frequent()

    ids = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    both = store(ids.mapInArrow(run, "doc_id bigint, n bigint, d1 bigint, d2 bigint, sketch binary"))
    often = both.where("doc_id IS NULL").groupBy("d1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d1").limit(MAX_FREQUENT)
    frequent = np.sort(often.select("d1").toPandas()["d1"].to_numpy(np.int64).astype(np.uint64))
    return both.where("doc_id IS NOT NULL"), frequent


def _prefixes(docs: DataFrame, join: Join, frequent: np.ndarray) -> DataFrame:
    """(tok, d1, d2, n): the beginning of every set in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in blocks(batches):
            toks, ds, ns = [], [], []
            for s in _sets(data, offsets, join.k):
                if len(s):
                    n = len(s)
                    toks.append(_ordered(s, shared.value)[: n - needed(n, join.percent) + 1])
                    ds.append(_digest(s))
                    ns.append(n)
            if toks:
                times = np.array([len(t) for t in toks])
                d = np.repeat(np.array(ds, np.int64), times, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(toks).astype(np.int64)), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array(np.repeat(np.array(ns, np.int32), times))],
                    ["tok", "d1", "d2", "n"],
                )

    return docs.select("text").mapInArrow(run, "tok bigint, d1 bigint, d2 bigint, n int")


class Trie:
    """Ordered sets as a path-compressed tree. Edges are short near the root and longer below, so that a walk can stop early.

    Walks skip subtrees whose members are all linked with the walked set already: what they give is a spanning forest.
    """

    def __init__(self, sets: list[np.ndarray], rank: list[int]):
        """rank: the sets' numbers, ordered so that equal beginnings are neighbours."""
        self.sets, self.group = sets, np.arange(len(sets))
        self.root = self._node(rank, 0)

    def _node(self, members: list[int], depth: int) -> dict:
        """Members that end at this depth, and the edges below: their shingles in one array, members and extreme sizes."""
        rest = [m for m in members if len(self.sets[m]) > depth]
        edges, heads, a = [], [], 0
        while a < len(rest):
            b, first = a + 1, self.sets[rest[a]][depth]
            while b < len(rest) and self.sets[rest[b]][depth] == first:
                b += 1
            below = rest[a:b]
            x, y = self.sets[below[0]], self.sets[below[-1]]
            n = min(depth + max(32, 4 * depth), *(len(self.sets[m]) for m in below), len(x)) - depth
            differ = np.flatnonzero(x[depth : depth + n] != y[depth : depth + n])
            n = int(differ[0]) if len(differ) else n
            edges.append((below, depth + n))
            heads.append(x[depth : depth + n])
            a = b
        sizes = [[len(self.sets[m]) for m in below] for below, _ in edges]
        return {
            "leaves": [m for m in members if len(self.sets[m]) == depth],
            "edges": edges,
            "heads": np.concatenate(heads) if heads else np.zeros(0, np.uint64),
            "cuts": np.cumsum([0, *map(len, heads)]),
            "members": np.array([m for below, _ in edges for m in below], np.int64),
            "firsts": np.cumsum([0, *(len(below) for below, _ in edges)])[:-1],
            "least": np.array([min(x) for x in sizes], np.int64),
            "most": np.array([max(x) for x in sizes], np.int64),
            "depth": depth,
            "below": {},
        }

    def link(self, q: int, percent: int) -> list[int]:
        """Members of other groups whose Jaccard similarity with q is at least percent / 100; their groups become one."""
        own = np.sort(self.sets[q])
        n, stack, found = len(own), [(self.root, 0)], []
        while stack:
            node, overlap = stack.pop()
            for leaf in node["leaves"]:
                m = len(self.sets[leaf])
                if self.group[leaf] != self.group[q] and 100 * overlap >= percent * (n + m - overlap):
                    found.append(leaf)
                    self.group[self.group == self.group[leaf]] = self.group[q]
            if not node["edges"]:
                continue
            # The most that a member below can share, were all its later shingles in q.
            open_ = np.logical_or.reduceat(self.group[node["members"]] != self.group[q], node["firsts"])
            open_ &= (100 * node["most"] >= percent * n) & (percent * node["least"] <= 100 * n)
            if not open_.any():
                continue
            at = np.minimum(np.searchsorted(own, node["heads"]), n - 1)
            hits = np.concatenate([[0], np.cumsum(own[at] == node["heads"])])
            got = overlap + hits[node["cuts"][1:]] - hits[node["cuts"][:-1]]
            depth = node["depth"] + np.diff(node["cuts"])
            best = np.minimum(got + node["most"] - depth, n)
            open_ &= 100 * best >= percent * (n + np.maximum(node["least"], best) - best)
            for k in np.flatnonzero(open_).tolist():
                if k not in node["below"]:
                    node["below"][k] = self._node(*node["edges"][k])
                stack.append((node["below"][k], int(got[k])))
        return found


def bucket_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ordered sets that meet in a bucket."""
    rank = sorted((k for k in range(len(sets)) if len(sets[k])), key=lambda k: sets[k].astype(">u8").tobytes())
    trie = Trie(sets, rank)
    return [(x, y) for x in rank for y in trie.link(x, percent)]


def _weight() -> Column:
    return F.greatest("n", F.lit(LEAST_WEIGHT))


def _candidate_rows(prefixes: DataFrame) -> DataFrame:
    """(bucket, d1, d2, n) in buckets of at least two different sets, each bucket of the same members once.

    Counts and extremes of a bucket are aggregates with map-side combine; no bucket is gathered.
    """
    counted = prefixes.groupBy("tok").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi"))
    several = counted.where("lo <> hi").select("tok")
    rows = store(prefixes.join(several, "tok").dropDuplicates(["tok", "d1", "d2"]))
    h = F.xxhash64("d1", "d2")
    buckets = rows.groupBy("tok").agg(F.count(F.lit(1)).alias("c"), F.sum(_weight()).alias("shingles"), F.bit_xor(h).alias("x"), F.sum(F.xxhash64("d2", "d1") / 2).cast("decimal(38,0)").alias("y"))
    # One of the buckets of the same members: their number, size and two sums of independent hashes agree.
    chosen = buckets.groupBy("c", "shingles", "x", "y").agg(F.min("tok").alias("tok"))
    return rows.join(chosen.select("tok", "c", "shingles"), "tok")


def _dealt(rows: DataFrame, percent: int) -> DataFrame:
    """Buckets as dealt to tasks. Large ones are parted by size class and then by pairs of shares that hold all pairs."""
    small = F.col("shingles") <= BUCKET_SHINGLES
    ratio = float(np.log(100 / percent)) * 1.001  # so that rounding never parts sizes that may link
    level = F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int")
    levels = F.when(small, F.array(F.lit(-1))).otherwise(F.array(level, level + 1))
    by_level = rows.withColumn("level", F.explode(levels))
    weight = by_level.groupBy("tok", "level").agg(F.sum(_weight()).alias("w"))
    weighed = by_level.join(weight, ["tok", "level"])
    shares = F.when(small, F.lit(1)).otherwise(F.ceil(2 * F.col("w") / BUCKET_SHINGLES).cast("int"))
    own = F.pmod(F.xxhash64("d2", "d1"), F.col("shares")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("shares") - 1), lambda s: F.struct(F.least(s, F.col("own")).alias("i"), F.greatest(s, F.col("own")).alias("j")))
    return weighed.withColumn("shares", shares).withColumn("own", own).withColumn("p", F.explode(pairs)).select(F.xxhash64("tok", "level", "p.i", "p.j").alias("bucket"), "first", "n", "sketch")


def _by_bucket(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """The rows of each bucket, from a partition that is sorted by bucket; None after each batch."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
        yield None
    if held:
        yield held
    yield None


def _plausible(n: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sketches and sizes allow a link."""
    group, out = np.arange(len(n)), []
    size = np.array([len(x) for x in sketches])
    for level in np.unique(size).tolist():
        own, above = np.flatnonzero(size == level), np.flatnonzero(size == 2 * level)
        words = np.frombuffer(b"".join(sketches[k] for k in own), np.uint64).reshape(len(own), -1)
        if len(above):
            wide = np.frombuffer(b"".join(sketches[k] for k in above), np.uint64).reshape(len(above), 2, -1)
            other, number = np.concatenate([words, wide[:, 0] ^ wide[:, 1]]), np.concatenate([own, above])
        else:
            other, number = words, own
        for k, w in zip(own.tolist(), words):
            m = n[number]
            at = np.flatnonzero((100 * np.minimum(m, n[k]) >= percent * np.maximum(m, n[k])) & (group[number] != group[k]))
            differ = np.bitwise_count(other[at] ^ w).sum(1, dtype=np.int64)
            near = number[at[(100 + percent) * differ <= (100 - percent) * (m[at] + n[k])]]
            for j in near.tolist():
                if group[j] != group[k]:
                    out.append((k, j))
                    group[group == group[j]] = group[k]
    return out


def _pairs(dealt: DataFrame, percent: int) -> DataFrame:
    """(bucket, a, b): in each bucket, a forest of the pairs that sketches do not rule out. A sketch never hides a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _by_bucket(batches, ("bucket", "first", "n", "sketch")):
            if rows is None:
                cols = np.array(out, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(cols[:, k].copy()) for k in range(3)], ["bucket", "a", "b"])
                out = []
            elif len(rows) > 1:
                made = _plausible(np.array([r[2] for r in rows], np.int64), [r[3] for r in rows], percent)
                out += [(rows[0][0], rows[x][1], rows[y][1]) for x, y in made]

    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket bigint, a bigint, b bigint")


def _regrouped(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(bucket, doc_id, d1, d2): where the trie links sets.

    Components of plausible pairs, each in one bucket, so that a text moves once. The few components beyond
    BUCKET_SHINGLES stay in the buckets of their shingles, where every pair that may link still meets.
    """
    roots = components(pairs.select("a", "b"))
    both = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    named = both.join(firsts.select(F.col("first").alias("node"), "d1", "d2", "n"), "node")
    weight = named.groupBy("root").agg(F.sum(_weight()).alias("w"))
    weighed = store(named.join(weight, "root"))
    small = weighed.where(F.col("w") <= BUCKET_SHINGLES).select(F.xxhash64(F.lit(1), "root").alias("bucket"), F.col("node").alias("doc_id"), "d1", "d2")
    rows = pairs.select("bucket", F.col("a").alias("node")).union(pairs.select("bucket", "b")).distinct()
    large = rows.join(weighed.where(F.col("w") > BUCKET_SHINGLES), "node").select("bucket", F.col("node").alias("doc_id"), "d1", "d2")
    h = F.xxhash64("d1", "d2")
    same = large.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h)).alias("y"))
    chosen = same.groupBy("c", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    return small.unionByName(large.join(chosen, "bucket"))


def _links(rows: DataFrame, join: Join, frequent: np.ndarray) -> DataFrame:
    """(a, b): doc_ids whose sets the trie of a bucket links. Sets are made again from the texts, which are smaller."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for held in _by_bucket(batches, ("bucket", "doc_id", "d1", "d2", "text")):
            if held is None:
                cols = np.array(out, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(cols[:, k].copy()) for k in range(2)], ["a", "b"])
                out = []
            elif len(held) > 1:
                raw = [r[4].encode() for r in held]
                offsets = np.cumsum([0, *map(len, raw)])
                sets = list(_sets(np.frombuffer(b"".join(raw), np.uint8), offsets, join.k))
                # A repeated doc_id may bring another text along.
                same = [_digest(s) == r[2:4] for s, r in zip(sets, held)]
                sets, held = [_ordered(s, shared.value) for s, ok in zip(sets, same) if ok], [r for r, ok in zip(held, same) if ok]
                out += [(held[x][1], held[y][1]) for x, y in bucket_links(sets, join.percent)]

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a bigint, b bigint")


def link_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row with a doc_id.

    Documents link when 100 * overlap >= percent * union. Null and empty texts have an empty set and link with nothing;
    equal sets link. component_id is the least doc_id that links reach. Rows of a repeated doc_id are treated as documents
    of their own that share that id; a row without doc_id is left out, as no link can name it. Very long texts are sets like
    others. An empty table gives no rows. Columns other than doc_id and text are not read, so they may have any name.
    """
    sets, frequent = shingle_sets(docs, join)
    firsts = store(sets.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.min("n").alias("n"), F.min("sketch").alias("sketch")))
    candidates = _candidate_rows(_prefixes(docs, join, frequent)).join(firsts.select("d1", "d2", "first", "sketch"), ["d1", "d2"])
    pairs = store(_pairs(_dealt(candidates, join.percent), join.percent))
    named = _regrouped(pairs, firsts)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    edges = _links(texts.join(named, "doc_id"), join, frequent)
    roots = components(edges)
    comps = firsts.join(roots, firsts["first"] == roots["node"], "left").select("d1", "d2", F.coalesce("root", "first").alias("component_id"))
    labelled = sets.join(comps, ["d1", "d2"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The documents without those that another of their component stands for; the least doc_id stays, with its repeated rows.

    Rows without doc_id stay. An empty table gives no rows; all columns of docs stay, whatever their names.
    """
    rest = link_components(docs, join).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(docs.columns)
