"""Exponents, budgets and permutations against plain versions."""

import math
import re
from collections import Counter, defaultdict

import pytest

from citeweave.llm import mixing
from citeweave.llm.catalogue import op6_temperature_mixing
from citeweave.llm.mixing import Mixing

from .common import WORD, awkward, empty


def shares(spark, sizes):
    total = sum(sizes)
    return spark.createDataFrame([(float(s) / total,) for s in sizes], "p double")


def entropy(p):
    return -sum(x * math.log(x) for x in p)


def weights(p, a):
    z = sum(x**a for x in p)
    return [x**a / z for x in p]


@pytest.mark.parametrize("target", [0.7, 0.9, 0.99])
def test_target_entropy(spark, target):
    sizes = [1000, 100, 50, 10]
    p = [s / sum(sizes) for s in sizes]
    a = mixing.bisect_exponent(shares(spark, sizes), Mixing(target_entropy=target, max_repetition=None))
    assert entropy(weights(p, a)) >= target * math.log(4) - 1e-9
    assert a == 1 or entropy(weights(p, a + 1e-5)) < target * math.log(4)


@pytest.mark.parametrize("limit", [1.0, 1.5, 4.0])
def test_repetition_limit(spark, limit):
    sizes = [1000, 100, 50, 10]
    p = [s / sum(sizes) for s in sizes]
    a = mixing.bisect_exponent(shares(spark, sizes), Mixing(max_repetition=limit))
    passes = [w / x for w, x in zip(weights(p, a), p)]
    assert max(passes) / min(passes) <= limit + 1e-9
    assert a == 0 or limit == 1 or (max(p) / min(p)) ** (1 - a + 1e-5) > limit


def test_even_sources_and_one_source(spark):
    assert mixing.bisect_exponent(shares(spark, [5, 5, 5]), Mixing(target_entropy=1.0, max_repetition=None)) == 1.0
    assert mixing.bisect_exponent(shares(spark, [5]), Mixing()) == 0.0


def mixed(spark, m):
    docs = spark.createDataFrame([(k, "w " * (1 + k % 7), "s0" if k % 3 else f"s{k % 5 + 1}") for k in range(3000)], "doc_id bigint, text string, source string")
    return docs, mixing.mix(docs, m).collect()


def test_realised_weights(spark):
    m = Mixing(max_repetition=2.5)
    docs, rows = mixed(spark, m)
    tokens = {r["doc_id"]: len(WORD.findall(r["text"])) for r in docs.collect()}
    used, target = Counter(), {}
    times = Counter(r["doc_id"] for r in rows)
    for r in rows:
        used[r["source"]] += tokens[r["doc_id"]]
        target[r["source"]] = r["mix_weight"]
    total = sum(used.values())
    assert sum(target.values()) == pytest.approx(1)
    assert all(used[s] / total == pytest.approx(w, rel=0.01) for s, w in target.items())
    assert set(times) == set(tokens) and max(times.values()) <= 3
    # Epochs of a document are 0, 1, ...; blocks stay whole in the order of slots, and passes differ in order.
    epochs, slots = defaultdict(list), defaultdict(set)
    for r in rows:
        epochs[r["doc_id"]].append(r["mix_epoch"])
        slots[r["source"], r["mix_epoch"], r["mix_block"]].add(r["mix_slot"])
    assert all(sorted(e) == list(range(len(e))) for e in epochs.values())
    assert all(len(s) == 1 for s in slots.values())
    order = lambda s, e: [b for _, b in sorted((min(v), k[2]) for k, v in slots.items() if k[:2] == (s, e))]
    repeated = next(s for s in target if (s, 1, 0) in slots or any(k[:2] == (s, 1) for k in slots))
    assert order(repeated, 0)[:5] != order(repeated, 1)[:5]


def test_prefixes_hold_the_mixture(spark):
    _, rows = mixed(spark, Mixing(max_repetition=2.5))
    rows = sorted(rows, key=lambda r: (r["mix_slot"], r["doc_id"]))
    half = Counter(r["source"] for r in rows[: len(rows) // 2])
    whole = Counter(r["source"] for r in rows)
    assert all(half[s] == pytest.approx(n / 2, rel=0.25) for s, n in whole.items())


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = op6_temperature_mixing(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len({(r["doc_id"], r["mix_epoch"]) for r in rows}) == len(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op6_temperature_mixing(spark, sf_dir).collect()))


def test_query_meets_its_budgets(spark):
    """The registered query against a plain account: shares within 1 %, and no block that is left out would still fit."""
    sf = "/root/testdata/sf0.01"
    tokens = {r["doc_id"]: (r["source"], max(1, len(WORD.findall(r["text"] or "")))) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_temperature_mixing(spark, sf).collect()
    size = Counter()
    for source, n in tokens.values():
        size[source] += n
    p = {s: n / sum(size.values()) for s, n in size.items()}
    fits = lambda a: max(x ** (a - 1) for x in p.values()) / min(x ** (a - 1) for x in p.values()) <= 1.5
    a = min(k / 4096 for k in range(4097) if fits(k / 4096))
    budget = {s: size[s] * x ** (a - 1) / min(y ** (a - 1) for y in p.values()) for s, x in p.items()}
    used, blocks, last = Counter(), defaultdict(Counter), defaultdict(set)
    for r in rows:
        source, n = tokens[r["doc_id"]]
        used[source] += n
        if r["mix_epoch"] == 0:
            blocks[source][r["mix_block"]] += n
        if r["mix_epoch"] == int(budget[source] / size[source]):
            last[source].add(r["mix_block"])
    for s in size:
        assert 0.99 * budget[s] <= used[s] <= 1.001 * budget[s]
        assert used[s] / sum(used.values()) == pytest.approx(budget[s] / sum(budget.values()), rel=0.01)
        assert all(used[s] + n > 0.999 * budget[s] for b, n in blocks[s].items() if b not in last[s])
    assert any(last.values())


def test_slots_order_the_stored_mixture(spark, sf_dir):
    made = [r["doc_id"] for r in mixing.mixed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()]
    slots = {(r["doc_id"], r["mix_epoch"]): r["mix_slot"] for r in op6_temperature_mixing(spark, sf_dir).collect()}
    epoch, at = Counter(), []
    for d in made:
        at.append(slots[d, epoch[d]])
        epoch[d] += 1
    assert at == sorted(at)


def test_token_counts(spark):
    from pyspark.sql import functions as F

    texts = ["a b\tc\n d", "", None, " \x0b ", "x y", "é\U0001f600 z"]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(mixing.count_tokens(F.col("t"))).collect()]
    assert got == [max(1, len(WORD.findall(t or ""))) for t in texts]


def test_awkward_rows(spark):
    docs = awkward(spark)
    made = mixing.mixed_documents(docs)
    assert made.columns == docs.columns and docs.exceptAll(made).count() == 0
    assert mixing.mix(empty(spark)).count() == 0
    clash = docs.withColumnRenamed("rule", "mix_weight")
    kept = mixing.mixed_documents(clash)
    assert kept.columns == clash.columns and clash.exceptAll(kept).count() == 0
    assert sorted(mixing.mix(clash).columns) == sorted([*(c for c in clash.columns if c != "mix_weight"), "mix_weight", "mix_epoch", "mix_block", "mix_slot"])


def test_main_path_is_native(spark, sf_dir):
    plan = op6_temperature_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
