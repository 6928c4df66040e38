"""Audit of filter interactions: what each filter removes at each step of every order, by part and label.

The filters that a document fails are a mask of five bits, so one of 32 values. A table of 32 masks by 120 orders has the
step at which an order removes such a document. Tasks look masks up in it and add removals up with np.bincount; Spark
sums what they found, cell by cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import blocks, segment_sums, store

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: The filter of each step of each order.
_AT = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
_DUPLICATE = 1 << FILTERS.index("E")
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*|")] = True
#: Masks that are looked up at once, and parts whose sums a task holds (about 18 kB each) before it passes them on.
_ROWS, _PARTS = 4096, 1024
#: Steps and the place for documents that no filter removes.
_STEPS = len(FILTERS) + 1
_CELLS = len(ORDERS) * _STEPS


def first_failures() -> np.ndarray:
    """(32, 120): the step, from 0, at which an order removes a document with this mask; 5 if none does."""
    failing = (np.arange(1 << len(FILTERS))[:, None, None] >> _AT[None]) & 1
    return np.where(failing.any(2), failing.argmax(2), len(FILTERS))


def fail_masks(docs: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, part, mask): bits 0 to 4 for the filters A to E.

    A: under 50 words; B: 100 * distinct words < 65 * words; C: 100 * [A-Z] > 5 * code points; D: any of #$%&*|;
    E: the text is that of a smaller doc_id. Texts are compared by 128-bit digests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            starts, ends = offsets[:-1], offsets[1:]
            points = segment_sums((data & 0xC0) != 0x80, starts, ends)
            capitals = segment_sums((data >= 65) & (data <= 90), starts, ends)
            marks = segment_sums(_MARKS[data], starts, ends)
            raw, words, distinct, digests = data.tobytes(), [], [], []
            for a, b in zip(starts.tolist(), ends.tolist()):
                found = raw[a:b].split()  # at blanks and the bytes 9 to 13
                words.append(len(found))
                distinct.append(len(set(found)))
                digests.append(hashlib.blake2b(raw[a:b], digest_size=16).digest())
            n, kinds = np.array(words), np.array(distinct)
            fails = [n < 50, 100 * kinds < 65 * n, 100 * capitals > 5 * points, marks > 0]
            mask = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("part"), pa.array(mask, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    seen = store(named.mapInArrow(run, "doc_id bigint, part string, mask int, digest binary"))
    # The first of each text, met again by its own doc_id: a text that a third of all rows share stays spread out.
    first = seen.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    known = seen.where("doc_id IS NOT NULL").join(first, ["doc_id", "digest"], "left")
    later = F.when(F.col("is_first").isNull(), F.lit(_DUPLICATE)).otherwise(F.lit(0))
    without = seen.where("doc_id IS NULL").select("doc_id", "part", "mask")
    return known.select("doc_id", "part", F.col("mask").bitwiseOR(later).alias("mask")).unionByName(without)


def with_labels(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good and toxic (0 or 1). A document with several labels is good if one says so, and toxic likewise."""
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = masks.where("doc_id IS NOT NULL").join(said, "doc_id", "left").select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return marked.unionByName(masks.where("doc_id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic")))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part of a task, one array: documents by mask, then removals by order and step: all, good, toxic."""
    table, orders, held = first_failures(), np.arange(len(ORDERS)) * _STEPS, {}

    def passed_on() -> pa.RecordBatch:
        sums = [np.concatenate([masks, *removed]) for masks, removed in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(sums, pa.list_(pa.int64()))], ["part", "cells"])

    for batch in batches:
        coded = batch.column("part").dictionary_encode()
        names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        mask, good, toxic = (batch.column(c).to_numpy() for c in ("mask", "good", "toxic"))
        for code, name in enumerate(names):
            if name not in held and len(held) >= _PARTS:
                yield passed_on()
                held.clear()
            masks, removed = held.setdefault(name, (np.zeros(1 << len(FILTERS), np.int64), np.zeros((3, _CELLS), np.int64)))
            own = np.flatnonzero(codes == code) if len(names) > 1 else np.arange(len(mask))
            masks += np.bincount(mask[own], minlength=len(masks))
            for a in range(0, len(own), _ROWS):
                rows = own[a : a + _ROWS]
                cells = table[mask[rows]] + orders
                for k, chosen in enumerate((slice(None), good[rows] == 1, toxic[rows] == 1)):
                    removed[k] += np.bincount(cells[chosen].ravel(), minlength=_CELLS)
    if held:
        yield passed_on()


def _report(found: pa.Table) -> pa.Table:
    """All orders and steps of one part, from its at most 2192 sums."""
    cells = np.zeros((1 << len(FILTERS)) + 3 * _CELLS, np.int64)
    cells[found.column("pos").to_numpy()] = found.column("n").to_numpy()
    masks = cells[: 1 << len(FILTERS)]
    removed, good, toxic = cells[len(masks) :].reshape(3, len(ORDERS), _STEPS)[:, :, :-1]
    has = (np.arange(len(masks))[:, None] >> np.arange(len(FILTERS))) & 1
    fails, alone = masks @ has, masks[1 << np.arange(len(FILTERS))]
    shapley = np.bincount(_AT.ravel(), removed.ravel()).astype(np.int64)
    figures = {
        "kept": masks.sum() - removed.cumsum(1), "removed": removed, "redundant": fails[_AT] - removed, "unique_fails": alone[_AT],
        "good_lost": good, "toxic_lost": toxic, "shapley": shapley[_AT],
    }
    steps = np.tile(np.arange(1, _STEPS, dtype=np.int32), len(ORDERS))
    part = pa.repeat(pa.scalar(found.column("part")[0].as_py(), pa.string()), len(steps))
    order = pa.array([o for o in ORDERS for _ in FILTERS], pa.string())
    return pa.Table.from_arrays([part, order, pa.array(steps), *[pa.array(v.ravel()) for v in figures.values()]], ["part", "filter_order", "step", *figures])


REPORT = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def audit_orders(marked: DataFrame) -> DataFrame:
    """marked: part, mask, good, toxic. One row per part, order of the five filters and step."""
    partial = marked.select("part", "mask", "good", "toxic").mapInArrow(_partial, "part string, cells array<bigint>")
    sums = partial.select("part", F.posexplode("cells").alias("pos", "v")).where("v > 0").groupBy("part", "pos").agg(F.sum("v").alias("n"))
    return sums.groupBy("part").applyInArrow(_report, REPORT)


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """What the filters A to E remove in each of their 120 orders, per part.

    Null texts are empty texts, which fail A alone (0 < 65 * 0 does not hold) and E behind a smaller doc_id with an
    empty text. A null part is the part of the empty string. A row without doc_id fails E never, is no document's
    copy and has no label; rows of one doc_id count each, and are no copies of one another. Very long texts are read
    whole. An empty table has no parts and gives no rows; further columns of docs and labels do not matter.
    """
    return audit_orders(with_labels(fail_masks(docs, part), labels))
