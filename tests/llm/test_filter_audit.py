"""The audit of filter orders against a plain simulation of every order, and against SQL."""

import random
from itertools import permutations
from pathlib import Path

import duckdb
import numpy as np
import pytest

from citeweave.llm import filter_audit
from citeweave.llm.catalogue import OP11_SQL, op11_filter_audit

from .common import awkward, empty, words

LABELS = "doc_id bigint, quality int, toxic int"


def plain_failures(rows):
    """Letters that each (doc_id, text) fails."""
    out = []
    for d, text in rows:
        text, w = text or "", words(text)
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if d is not None and any(e is not None and e < d and (u or "") == text for e, u in rows):
            fails.add("E")
        out.append(fails)
    return out


def plain_audit(rows, labels):
    """Every order applied filter by filter to the documents that are left."""
    fails = plain_failures([(d, t) for d, t, _ in rows])
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    out = {}
    for part in {s or "" for _, _, s in rows}:
        own = [(d, f) for (d, _, s), f in zip(rows, fails) if (s or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone, left = [x for x in left if name in x[1]], [x for x in left if name not in x[1]]
                removed_by[name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(name in f for _, f in own) - len(gone), sum(f == {name} for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def found(spark, docs, labels):
    return {(r[0], r[1], r[2]): list(r[3:]) for r in filter_audit.audit_filters(docs, spark.createDataFrame(labels, LABELS)).collect()}


def test_table_is_the_first_failing_step():
    table = filter_audit.first_failures()
    assert table.shape == (32, 120) and len(set(filter_audit.ORDERS)) == 120
    for mask in range(32):
        for k, order in enumerate(filter_audit.ORDERS):
            steps = [s for s, f in enumerate(order) if mask >> "ABCDE".index(f) & 1]
            assert table[mask, k] == min(steps, default=5)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_documents(spark, seed):
    r = random.Random(seed)
    rows = []
    for d in range(150):
        if rows and r.random() < 0.25:
            text = r.choice(rows)[1]
        else:
            n, kinds = r.choice([0, 10, 49, 50, 80, 200]), r.choice([5, 40, 1000])
            text = " ".join(r.choice(["w", "W", "É"]) * r.randint(1, 2) + str(r.randrange(kinds)) for _ in range(n)) + r.choice(["", "", " #", " $5"])
        rows.append((d if r.random() < 0.95 else None, text if text or r.random() < 0.5 else None, r.choice(["a", "b", None, ""])))
    labels = [(r.choice([d, None, 7]), r.choice([0, 1, None]), r.choice([0, 1, None])) for d in range(0, 150, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    assert found(spark, docs, labels) == plain_audit(rows, labels)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(x["doc_id"], x["text"], x["source"]) for x in docs.collect()]
    assert found(spark, docs, []) == plain_audit(rows, [])
    assert filter_audit.audit_filters(empty(spark), spark.createDataFrame([], LABELS)).count() == 0


def test_parts_are_passed_on_when_many(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "_PARTS", 3)
    batches = spark.createDataFrame([(f"p{k % 10}", k % 32, k % 2, 0) for k in range(500)], "part string, mask int, good int, toxic int").toArrow().to_batches(100)
    partial = [row for batch in filter_audit._partial(iter(batches)) for row in batch.to_pylist()]
    assert len(partial) > 10
    sums = np.sum([row["cells"] for row in partial], axis=0)
    assert sums[:32].sum() == 500 and sums[32 : 32 + 720].sum() == 500 * 120


def test_hot_text_keeps_its_first(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the same text', concat('text ', id)) AS text", "'s' AS source")
    masks = {(r["doc_id"]): r["mask"] for r in filter_audit.fail_masks(docs).collect()}
    assert [d for d, m in masks.items() if m & 16] == [d for d in masks if d % 3 == 0 and d > 0]


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{Path(sf_dir)}/{t}.parquet'")
    frame, other = op11_filter_audit(spark, sf_dir), con.sql(OP11_SQL)
    assert frame.columns == other.columns and sorted(map(tuple, frame.collect())) == sorted(other.fetchall())
