"""Phrase collocations: phrases of up to four words, counted exactly, scored by their weakest cut.

Texts become blocks of pieces of one language. A sketch counts all phrases of all blocks in hashed cells, so that a cell's
sum is an upper bound for each of its phrases; it is a Spark table dealt out by slices of the cells, as many as the words
need, and is never held whole. Each slice tells every block which of the block's own cells reach the threshold. Those are
the block's candidates: they are compiled into an Aho-Corasick automaton, with a blank around every phrase, which counts
all overlapping matches in the block. Spark sums the counts, and thresholds apply to sums alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.common import blocks, mix64, store, windows, word_hashes

UNKNOWN = "und"
_ENDS = frozenset(b".,;:!?\n\v\f\r")
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 10 if b in _ENDS else 32 if b == 9 else b for b in range(256))
_TEXTS = "block bigint, lang string, text string, carried int, n_words bigint"


@dataclass(frozen=True)
class Mining:
    longest: int = 4
    least: int = 30
    #: Scores are floored at this many parts.
    scale: int = 2_000_000
    #: A longer phrase with this share of a candidate's occurrences, in percent, takes its place.
    absorbs: int = 80
    top: int = 2000
    #: Bytes of a block of pieces, and cells of a slice: what a task holds at once. They change the work, not the result.
    block_bytes: int = 1 << 21
    slice_cells: int = 1 << 21
    #: Rows of one language that a task ranks, about.
    rank_rows: int = 200_000


def pieces(text: bytes) -> list[bytes]:
    """Pieces that have a word: lower case, one blank between words."""
    return [p for x in text.translate(_PLAIN).split(b"\n") if (p := b" ".join(x.split()))]


def _cut(piece: bytes, m: Mining) -> Iterator[tuple[bytes, int]]:
    """A piece larger than a block in parts; each begins with the last words of the one before, as many as it says."""
    carried, least = 0, 0
    while len(piece) > m.block_bytes:
        end = piece.find(b" ", max(m.block_bytes, least))  # behind one new word at least
        if end < 0:
            break
        yield piece[:end], carried
        words = piece[:end].rsplit(b" ", m.longest - 1)[1 - m.longest :]
        carried, least = len(words), len(b" ".join(words)) + 1
        piece = b" ".join([*words, piece[end + 1 :]])
    yield piece, carried


def text_blocks(docs: DataFrame, m: Mining = Mining(), lang: str = "lang") -> DataFrame:
    """Blocks of pieces, a line each, of one language; about block_bytes each, however long texts and pieces are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: Counter = Counter()
        nth = TaskContext.get().partitionId() << 33

        def block(name: str, lines: list[bytes], carried: int) -> pa.RecordBatch:
            nonlocal nth
            nth += 1
            text = b"\n".join(lines)
            n = text.count(b" ") + len(lines) - carried
            values = [[nth], [name], [text.decode("utf-8", "replace")], [carried], [n]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64()))], ["block", "lang", "text", "carried", "n_words"])

        for rows, data, offsets in blocks(batches):
            raw, at = data.tobytes(), offsets.tolist()
            for name, a, b in zip(rows.column("lang").to_pylist(), at, at[1:]):
                for piece in pieces(raw[a:b]):
                    if len(piece) > m.block_bytes:
                        for part, carried in _cut(piece, m):
                            yield block(name, [part], carried)
                        continue
                    held.setdefault(name, []).append(piece)
                    size[name] += len(piece) + 1
                    if size[name] > m.block_bytes:
                        yield block(name, held.pop(name), 0)
                        del size[name]
                    elif len(size) > 8 and size.total() > 4 * m.block_bytes:  # many languages: the fullest goes first
                        (full, _), = size.most_common(1)
                        yield block(full, held.pop(full), 0)
                        del size[full]
        for name, lines in held.items():
            yield block(name, lines, 0)

    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), "text").mapInArrow(run, _TEXTS)


@dataclass
class Grams:
    """Phrases of a block: where each begins, how many words it has, and a hash of it and the language."""

    first: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    #: Where each word of the block begins and ends.
    starts: np.ndarray
    ends: np.ndarray


def grams(text: bytes, lang: str, carried: int, longest: int) -> Grams:
    data = np.frombuffer(text, np.uint8)
    hashes, _ = word_hashes(data, np.array([0, len(data)]), False)
    parted = (data == 32) | (data == 10)
    starts = np.flatnonzero(~parted & np.concatenate([[True], parted[:-1]]))
    ends = np.flatnonzero(~parted & np.concatenate([parted[1:], [True]])) + 1
    line = np.cumsum(data == 10)[starts]
    seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "replace")))
    first, words, found = [], [], []
    for k in range(1, min(longest, len(hashes)) + 1):
        # In one line, and not all in words that the part before has counted.
        at = np.flatnonzero((line[: len(line) - k + 1] == line[k - 1 :]) & (np.arange(len(line) - k + 1) + k > carried))
        first.append(at)
        words.append(np.full(len(at), k))
        found.append(mix64(windows(hashes, k)[at] ^ seed))
    none = np.zeros(0, np.int64)
    return Grams(np.concatenate([none, *first]), np.concatenate([none, *words]), np.concatenate([none.astype(np.uint64), *found]), starts, ends)


def _cells(hashes: np.ndarray, slices: int) -> np.ndarray:
    """Slice in the upper half, place in the slice in the lower half."""
    return (hashes >> np.uint64(40)) % np.uint64(slices) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def _by_slice(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of sorted cells, and where each begins (with the end)."""
    of = (cells >> np.uint64(32)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return of[begins], np.append(begins, len(of))


def _sketch(texts: DataFrame, slices: int, m: Mining) -> DataFrame:
    """For each block and slice the cells and their counts, of which a byte each is enough to reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                g = grams(row["text"].encode(), row["lang"], row["carried"], m.longest)
                cells, n = np.unique(_cells(g.hashes, slices), return_counts=True)
                low, n = cells.astype(np.uint32), np.minimum(n, 255).astype(np.uint8)
                of, at = _by_slice(cells)
                ends = list(zip(at.tolist(), at[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of, pa.int64()), pa.array([row["block"]] * len(of), pa.int64()), pa.array([low[a:b].tobytes() for a, b in ends], pa.binary()), pa.array([n[a:b].tobytes() for a, b in ends], pa.binary())],
                    ["slice", "block", "cells", "counts"],
                )

    return texts.mapInArrow(run, "slice bigint, block bigint, cells binary, counts binary")


def _replies(sketch: DataFrame, m: Mining) -> DataFrame:
    """For each block and slice, a bit for each of its cells: whether the sum over all blocks reaches the threshold."""
    if m.least > 255:
        raise ValueError("a threshold up to 255 is counted in a byte")

    def answer(found: pa.Table) -> pa.Table:
        cells = [np.frombuffer(x, np.uint32) for x in found.column("cells").to_pylist()]
        joined = np.concatenate(cells)
        order = np.argsort(joined, kind="stable")
        begins = np.flatnonzero(np.concatenate([[True], np.diff(joined[order]) != 0]))
        counts = np.frombuffer(b"".join(found.column("counts").to_pylist()), np.uint8)[order]
        heavy = np.zeros(len(joined), bool)
        heavy[order] = np.repeat(np.add.reduceat(counts, begins, dtype=np.int64) >= m.least, np.diff(np.append(begins, len(joined))))
        at = np.cumsum([0, *map(len, cells)])
        flags = [np.packbits(heavy[a:b]).tobytes() if heavy[a:b].any() else None for a, b in zip(at, at[1:])]
        return pa.table([found.column("block"), found.column("slice"), pa.array(flags, pa.binary())], ["block", "slice", "flags"]).filter(pa.array([f is not None for f in flags]))

    return sketch.groupBy("slice").applyInArrow(answer, "block bigint, slice bigint, flags binary")


def _flagged(cells: np.ndarray, replies: list[dict]) -> np.ndarray:
    """Cells of a block, sorted, that reach the threshold."""
    of, at = _by_slice(cells)
    place = {s: k for k, s in enumerate(of.tolist())}
    out = np.zeros(len(cells), bool)
    for r in replies:
        a, b = at[place[r["slice"]] : place[r["slice"]] + 2]
        out[a:b] = np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=b - a)
    return cells[out]


def scan(text: str, carried: int, phrases: list[str]) -> np.ndarray:
    """Matches of each phrase in a block, overlapping ones too; none wholly in the words that are carried over."""
    machine = ahocorasick.Automaton()
    for k, phrase in enumerate(phrases):
        machine.add_word(f" {phrase} ", k)
    machine.make_automaton()

    def matches(guarded: str) -> np.ndarray:
        return np.bincount(np.fromiter((k for _, k in machine.iter(guarded)), np.int64), minlength=len(phrases))

    found = matches(f" {text} ".replace("\n", " \n "))
    return found - matches(f" {' '.join(text.split(' ', carried)[:carried])} ") if carried else found


def _candidates(text: bytes, g: Grams, heavy: np.ndarray, slices: int) -> tuple[list[str], int]:
    """Phrases of heavy cells, and how often they stand in the block all together."""
    cells = _cells(g.hashes, slices)
    at = np.searchsorted(heavy, cells)
    chosen = np.flatnonzero(np.append(heavy, 0)[at] == cells) if len(heavy) else at[:0]
    _, one = np.unique(g.hashes[chosen], return_index=True)
    one = chosen[one]
    begins, ends = g.starts[g.first[one]], g.ends[g.first[one] + g.words[one] - 1]
    return [text[a:b].decode("utf-8", "replace") for a, b in zip(begins.tolist(), ends.tolist())], len(chosen)


def _counts(answered: DataFrame, slices: int, m: Mining) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"].encode()
                g = grams(text, row["lang"], row["carried"], m.longest)
                heavy = _flagged(np.unique(_cells(g.hashes, slices)), row["replies"])
                phrases, places = _candidates(text, g, heavy, slices)
                if not phrases:
                    continue
                n = scan(row["text"], row["carried"], phrases)
                if n.sum() != places:  # two phrases of one hash: all phrases at the places of heavy cells
                    known = np.isin(_cells(g.hashes, slices), heavy)
                    begins, ends = g.starts[g.first[known]], g.ends[g.first[known] + g.words[known] - 1]
                    phrases = sorted({text[a:b].decode("utf-8", "replace") for a, b in zip(begins.tolist(), ends.tolist())})
                    n = scan(row["text"], row["carried"], phrases)
                yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(n, pa.int64())], ["lang", "phrase", "n"])

    return answered.mapInArrow(run, "lang string, phrase string, n bigint")


def phrase_counts(texts: DataFrame, m: Mining = Mining()) -> DataFrame:
    """lang, phrase, words, n: every phrase of 1 to longest words that stands in the texts of its language least times or more. texts: stored text_blocks."""
    words = texts.agg(F.sum("n_words")).first()[0] or 0
    slices = max(1, -(-m.longest * words // m.slice_cells))
    replies = store(_replies(_sketch(texts, slices, m), m))
    # A block has at most one reply of each slice.
    of_block = replies.groupBy("block").agg(F.collect_list(F.struct("slice", "flags")).alias("replies"))
    answered = texts.join(of_block, "block").select("lang", "text", "carried", "replies")
    summed = _counts(answered, slices, m).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= m.least)
    return store(summed.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "n"))


def weakest_cuts(counts: DataFrame, m: Mining = Mining()) -> DataFrame:
    """lang, phrase, words, a, l, r, score of each phrase of two or more words, by the cut with the lowest score."""
    whole = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cut = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "*", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - words)").alias("right")
    )
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    # Decimals, as the product may pass 64 bits.
    score = F.expr(f"CAST({m.scale} * CAST(a AS DECIMAL(20, 0)) div (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    scored = cut.select("lang", "phrase", "words", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    return scored.groupBy("lang", "phrase", "words", "a").agg(F.min("cut").alias("cut")).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def not_absorbed(scored: DataFrame, counts: DataFrame, m: Mining = Mining()) -> DataFrame:
    """Without phrases that stand inside a longer one which has most of their occurrences."""
    longer = counts.where("words > 2").withColumn("w", F.split("phrase", " "))
    size = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("k"))
    inner = size.select("lang", "n", F.explode(F.expr("transform(sequence(1, words - k + 1), i -> array_join(slice(w, i, k), ' '))")).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    share = F.expr(f"100 * CAST(most AS DECIMAL(20, 0)) >= {m.absorbs} * CAST(a AS DECIMAL(20, 0))")
    return scored.join(most, ["lang", "phrase"], "left").where(F.col("most").isNull() | ~share).drop("most")


def first_of_each(scored: DataFrame, m: Mining = Mining()) -> DataFrame:
    """The first top rows of each language, with their rank. Beginnings of ever fewer shares are ranked, so no task sorts a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept, shares = scored, 1
    rows = scored.count()
    while shares * m.rank_rows < rows:
        shares *= 64
    while shares > 1:
        share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
        nth = F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))
        kept, shares = kept.withColumn("rank", nth).where(F.col("rank") <= m.top).drop("rank"), shares // 64
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return kept.withColumn("rank", rank).where(F.col("rank") <= m.top)


def mine(docs: DataFrame, m: Mining = Mining(), lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the collocations of each language, best first.

    Null texts are empty and add nothing; a null language is und, and meets the texts that say so. Rows without doc_id
    and repeated rows count like others. Very long texts and pieces are cut into parts that share three words, so no
    phrase is lost or counted twice. Phrases of equal score and count stand in byte order. A table without a phrase
    that is frequent enough gives no rows; further columns do not matter.
    """
    texts = store(text_blocks(docs, m, lang))
    total = texts.groupBy("lang").agg(F.sum("n_words").alias("n"))
    counts = phrase_counts(texts, m)
    scored = store(not_absorbed(weakest_cuts(counts, m), counts, m))
    ranked = first_of_each(scored, m).join(total, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
