"""Shared helpers: scratch tables, bounded text blocks of Arrow batches, and vectorised word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from citeweave.storage import remove

#: Text bytes that a Python worker holds at once (one longer document makes a block of its own).
BLOCK_BYTES = 1 << 20


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which executors and driver share. Only a session on this machine alone may lack it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{root.rstrip('/')}/citeweave-{uuid.uuid4().hex}"


#: Folders of the stage that is being built, and of each stage of an application.
_open: list[list[str]] = []
_left: dict[tuple[str, str], list[str]] = {}


@contextmanager
def stage_scratch(spark: SparkSession, name: str, before: str | None = None) -> Iterator[None]:
    """What is stored inside belongs to stage name. What stage before has stored goes: its result has been written by now."""
    app = spark.sparkContext.applicationId
    for path in _left.pop((app, before), []):
        remove(spark, path)
    _open.append(_left.setdefault((app, name), []))
    try:
        yield
    finally:
        _open.pop()


def store(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts the lineage and survives lost executors."""
    path, spark = scratch(df.sparkSession), df.sparkSession
    if _open:
        _open[-1].append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts batches at document boundaries: (rows, UTF-8 bytes, offsets of each document). Null texts are empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        filled = pc.fill_null(column, "").cast(pa.large_string())
        offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
        a = 0
        while a < len(batch):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            a = b


def texts(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw, at = data.tobytes(), offsets.tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]


def code_points(found: list[str], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each after pad zeros; where each text starts and ends."""
    gap = "\0" * pad
    joined = gap + gap.join(found)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.cumsum(lengths + pad) - lengths
    return points, starts, starts + lengths


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end], in float64 or int64; empty segments give 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, dtype=total.dtype, out=total[1:])
    return total[ends] - total[starts]


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES * 2)
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of bytes other than blank and 9-13) of all documents; words before each document.

    A polynomial over random byte values, taken from prefix sums, so that no Python code runs per word.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(inside & first)
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = ~inside[1:]
    inner = offsets[1:-1]
    last[inner[inner > 0] - 1] = True
    ends = np.flatnonzero(inside & last) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLDED if fold_case else _BYTES)[data] * up[:n], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return hashes, np.searchsorted(starts, offsets)


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of one document."""
    h = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9FB21C651E98DF25) + words[j : len(words) - k + 1 + j]
    return mix64(h + np.uint64(k))
