"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last WINDOW lines ends a chunk where it falls in one of DIVISOR classes, so
boundaries depend on nearby content alone and shift with it. A line of long_words or more is a passage by itself, as if
wrapped: chunks also end before and after it. Chunks of two or more lines, or of long_words, that occur again, in any
document, are removed except at their first place; equal hashes are confirmed by comparing the chunks' bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from citeweave.llm.common import blocks, store, texts

_BLANK = " \t\n\v\f\r"
_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15
_SEEN = ArrayType(StructType([StructField("h", BinaryType()), StructField("raw", BinaryType())]))


@dataclass(frozen=True)
class Chunking:
    #: A chunk has about divisor lines more than least_lines - 1.
    divisor: int = 2
    window: int = 3
    least_lines: int = 2
    long_words: int = 50
    #: Chunks with fewer bytes are left alone.
    least_bytes: int = 64
    #: Bytes of a chunk's hash; at 16, two chunks under one hash are not to be expected, and still compared.
    digest_size: int = 16


def chunk_lines(lines: list[str], c: Chunking) -> list[tuple[int, int]]:
    """(from, to) of each chunk of lines."""
    out, start, rolled = [], 0, 0
    oldest = pow(_FACTOR, c.window, _MASK + 1)
    hashes = [xxhash.xxh3_64_intdigest(line.encode()) for line in lines]
    long = [len(line) >= 2 * c.long_words - 1 and len(line.split()) >= c.long_words for line in lines]
    for k, h in enumerate(hashes):
        # The line that leaves the window takes its share of the sum along.
        rolled = (rolled * _FACTOR + h - (hashes[k - c.window] * oldest if k >= c.window else 0)) & _MASK
        met = k + 1 - start >= c.least_lines and (rolled >> 32) % c.divisor == 0
        if met or long[k] or k + 1 < len(lines) and long[k + 1]:
            out.append((start, k + 1))
            start = k + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def _chunks(text: str, c: Chunking) -> tuple[list[str], list[tuple[int, int, bytes | None, bytes]]]:
    """Lines, and (from, to, digest, bytes) of each chunk; no digest for chunks that are left alone."""
    lines = text.split("\n")
    out = []
    for a, b in chunk_lines(lines, c):
        raw = "\n".join(lines[a:b]).encode()
        whole = len(raw) >= c.least_bytes and (sum(1 for x in lines[a:b] if x.strip(_BLANK)) >= c.least_lines or sum(len(x.split()) for x in lines[a:b]) >= c.long_words)
        out.append((a, b, hashlib.blake2b(raw, digest_size=c.digest_size).digest() if whole else None, raw))
    return lines, out


def _occurrences(docs: DataFrame, c: Chunking) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            out = []
            for d, text in zip(rows.column("doc_id").to_pylist(), texts(data, offsets)):
                out += [(d, h) for _, _, h, _ in _chunks(text, c)[1] if h]
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], ["doc_id", "h"])

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(run, "doc_id bigint, h binary")


def _cut(marked: DataFrame, c: Chunking) -> DataFrame:
    """Adds cleaned, n_removed and seen: the bytes of every marked chunk, for comparison."""
    names = ["row", "text", "doc_id", "marks"]
    schema = marked.select(*names).schema.add("cleaned", "string").add("n_removed", "long").add("seen", _SEEN)
    kind = pa.list_(pa.struct([("h", pa.binary()), ("raw", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            cleaned, removed, seen = [], [], []
            for d, marks, null, text in zip(rows.column("doc_id").to_pylist(), rows.column("marks").to_pylist(), rows.column("text").is_null().to_pylist(), texts(data, offsets)):
                first = {m["h"]: m["first"] for m in marks or ()}
                if not first:
                    cleaned.append(None if null else text)
                    removed.append(0)
                    seen.append([])
                    continue
                lines, parts = _chunks(text, c)
                kept, gone, bytes_of, here = [], 0, {}, set()
                for a, b, h, raw in parts:
                    if h in first:
                        bytes_of.setdefault(h, raw)
                        if first[h] != d or h in here:
                            gone += b - a
                            continue
                        here.add(h)
                    kept += lines[a:b]
                cleaned.append("\n".join(kept))
                removed.append(gone)
                seen.append([{"h": h, "raw": raw} for h, raw in bytes_of.items()])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cleaned, pa.string()), pa.array(removed, pa.int64()), pa.array(seen, kind)], [*names, "cleaned", "n_removed", "seen"])

    return marked.select(*names).mapInArrow(run, schema)


def _cleaned(docs: DataFrame, c: Chunking, avoid: DataFrame | None = None) -> DataFrame:
    found = store(_occurrences(docs, c))
    repeated = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1").select("h", "first")
    if avoid is not None:
        repeated = repeated.join(avoid, "h", "left_anti")
    # Per document, its own repeated chunks; a chunk that thousands share is a row in each, never one list.
    # Written first, so that the planner knows their size and moves no text while they are small.
    marks = store(found.distinct().join(repeated, "h").groupBy("doc_id").agg(F.collect_list(F.struct("h", "first")).alias("marks")))
    rest = F.struct(*[x for x in docs.columns if x != "text"]).alias("row")
    keyed = docs.select(rest, "text", "doc_id").join(marks.withColumnRenamed("doc_id", "own"), F.col("doc_id") == F.col("own"), "left")
    return store(_cut(keyed, c))


def dedup_lines(docs: DataFrame, c: Chunking = Chunking(), verify: bool = True) -> DataFrame:
    """The documents with n_removed (lines), all columns kept and text without repeated chunks.

    A chunk stays in the document of least doc_id that has it, once. Rows of one doc_id count as one document; rows
    with a null doc_id and null texts stay as they are. A text that is all repeats becomes empty; no row is dropped.
    Very long texts are chunked whole. An empty table gives no rows. A column n_removed of docs is replaced; any other
    name does not matter.
    """
    docs = docs.drop("n_removed")
    done = _cleaned(docs, c)
    if verify:
        seen = done.select(F.explode("seen").alias("s")).groupBy("s.h", "s.raw").agg(F.count(F.lit(1)).alias("n"))
        differ = seen.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
        if not differ.isEmpty():  # different bytes under one 128-bit hash: such chunks are left alone
            done = _cleaned(docs, c, store(differ))
    cols = [done["cleaned"].alias("text") if x == "text" else done["row"][x].alias(x) for x in docs.columns]
    return done.select(*cols, "n_removed")


def clean_lines(docs: DataFrame, c: Chunking = Chunking()) -> DataFrame:
    """dedup_lines with the columns of docs alone."""
    clashing = {"n_removed": "_n_removed"} if "n_removed" in docs.columns else {}
    return dedup_lines(docs.withColumnsRenamed(clashing), c).select(*[F.col(clashing.get(x, x)).alias(x) for x in docs.columns])
