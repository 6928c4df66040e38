"""Mixing sources to target weights by temperature: DataFrame functions only.

Source shares p give weights p^a / sum(p^a). The exponent a is the largest in [0, 1] that meets a target entropy, or
the least that keeps repetition within a limit; bisected. The budget lets the most reduced source pass exactly once, so
no document is lost; other sources pass several times, each pass in another order of their blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import store

_LEVELS = 4
_UNIT = float(1 << 53)


@dataclass(frozen=True)
class Mixing:
    #: Exactly one of the two: entropy of the weights in nats as a share of its largest value, or passes at most.
    target_entropy: float | None = None
    max_repetition: float | None = 1.5
    seed: int = 7
    #: Blocks of every source, whatever its size: a block is about a thousandth of its source, or one document.
    blocks: int = 1024


def count_tokens(text: Column) -> Column:
    """Words; at least one, so that every document has weight."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint"), F.lit(1).cast("bigint"))


def _unit(*parts: Column | str) -> Column:
    """Uniform in [0, 1) by a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / _UNIT


def bisect_exponent(sources: DataFrame, m: Mixing, rounds: int = 6) -> float:
    """sources: one row a source, with share p. Each job halves the interval _LEVELS times: it tests all its inner points."""
    lo, hi = 0.0, 1.0
    for _ in range(rounds):
        points = [lo + (hi - lo) * k / 2**_LEVELS for k in range(2**_LEVELS + 1)]
        per = sources.select("p", F.explode(F.array(*map(F.lit, points))).alias("a"))
        logs = per.withColumn("l", F.log("p"))
        by = logs.groupBy("a").agg(
            F.sum(F.exp(F.col("a") * F.col("l"))).alias("z"),
            F.sum(F.exp(F.col("a") * F.col("l")) * F.col("a") * F.col("l")).alias("s"),
            F.exp(F.max((F.col("a") - 1) * F.col("l")) - F.min((F.col("a") - 1) * F.col("l"))).alias("repetition"),
            F.count(F.lit(1)).alias("n"),
        )
        entropy = F.log("z") - F.col("s") / F.col("z")
        met = entropy >= m.target_entropy * F.log("n") if m.target_entropy is not None else F.col("repetition") <= m.max_repetition
        good = {r["a"] for r in by.where(met).select("a").collect()}  # 17 numbers
        if m.target_entropy is not None:  # entropy falls with the exponent: the largest that meets it
            k = max((k for k, a in enumerate(points) if a in good), default=0)
            lo, hi = points[k], points[min(k + 1, len(points) - 1)]
        else:  # repetition falls with the exponent: the least that meets it
            k = min((k for k, a in enumerate(points) if a in good), default=len(points) - 1)
            lo, hi = points[max(k - 1, 0)], points[k]
    return lo if m.target_entropy is not None else hi


def plan_mixture(counted: DataFrame, m: Mixing) -> DataFrame:
    """source_key, tokens, weight, passes, cut, more: what each source contributes. counted: doc_id, source_key, n_tokens.

    passes is the budget of a source over its tokens. The last, partial pass takes the blocks whose rank hash is at
    most cut, the longest beginning of its permutation that keeps to the budget, and the blocks in more: of those behind,
    again and again the longest run of blocks that fit into what is left, until none fits. So a source misses its budget
    by less than its smallest block that is left out.
    """
    sources = counted.groupBy("source_key").agg(F.sum("n_tokens").alias("tokens"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    sources = store(sources.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1)))))
    a = bisect_exponent(sources, m)
    stats = sources.agg(F.sum(F.pow("p", F.lit(a))), F.max(F.pow("p", F.lit(1 - a)))).first()
    z, most = stats[0] or 1.0, stats[1] or 1.0
    # The budget is the least for which every source passes once or more: weight * budget / tokens >= 1.
    sources = sources.select(
        "source_key", "tokens",
        (F.pow("p", F.lit(a)) / z).alias("weight"),
        F.greatest(F.lit(1.0), F.pow("p", F.lit(a - 1)) * most).alias("passes"),
    )
    blocks = counted.groupBy("source_key", _block(m).alias("block")).agg(F.sum("n_tokens").alias("n")).join(sources, "source_key")
    last = F.floor("passes")
    budget = (F.col("passes") - last) * F.col("tokens")
    # A source has m.blocks rows here, whatever its size.
    open_ = store(blocks.select("source_key", "block", "n", _rank(m, F.col("source_key"), F.col("block"), last).alias("rank"), budget.alias("left"), F.lit(0).alias("round")))
    running = F.expr("sum(n) OVER (PARTITION BY source_key ORDER BY rank, block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    taken = None
    for k in range(m.blocks):
        placed = open_.withColumn("fits", running <= F.col("left"))
        new = placed.where("fits").select("source_key", "block", "rank", F.lit(k).alias("round"))
        used = placed.where("fits").groupBy("source_key").agg(F.sum("n").alias("used"))
        rest = placed.where("NOT fits").drop("fits").join(used, "source_key", "left").withColumn("left", F.col("left") - F.coalesce("used", F.lit(0))).drop("used")
        taken = new if taken is None else taken.unionByName(new)
        open_, taken = store(rest.where("n <= left")), store(taken)
        if open_.isEmpty():
            break
    cuts = taken.groupBy("source_key").agg(F.max(F.when(F.col("round") == 0, F.col("rank"))).alias("cut"), F.collect_list(F.when(F.col("round") > 0, F.col("block"))).alias("more"))
    joined = sources.join(cuts, "source_key", "left")
    return store(joined.withColumn("cut", F.coalesce("cut", F.lit(-1.0))).withColumn("more", F.coalesce("more", F.array().cast("array<int>"))))


def _block(m: Mixing) -> Column:
    return F.floor(_unit(F.lit(m.seed), "doc_id") * m.blocks).cast("int")


def _rank(m: Mixing, source: Column, block: Column, epoch: Column) -> Column:
    return _unit(F.lit(m.seed + 1), source, block, epoch.cast("bigint"))


def mix(docs: DataFrame, m: Mixing = Mixing()) -> DataFrame:
    """A row for each use of a document: its columns, then mix_weight, mix_epoch, mix_block and mix_slot.

    In the order of mix_slot (ties by doc_id) sources alternate at their weights, blocks of a pass are permuted as a
    whole, and every prefix holds the mixture. Every row of docs is used once or more. A null source counts as the
    empty name; a null or empty text as one token; an empty table gives no rows. Columns of docs with one of the four
    names are replaced.
    """
    key = F.coalesce("source", F.lit(""))
    counted = store(docs.select("doc_id", key.alias("source_key"), count_tokens(F.col("text")).alias("n_tokens")))
    own = "mix_"
    while any(c.startswith(own) for c in docs.columns):
        own = f"_{own}"
    at = lambda name: F.col(own + name)
    plan = plan_mixture(counted, m)
    joined = docs.join(plan.select(*[F.col(c).alias(own + c) for c in plan.columns]), key == at("source_key")).withColumn(own + "block", _block(m))
    last = F.floor(at("passes"))
    partial = (_rank(m, at("source_key"), at("block"), last) <= at("cut")) | F.array_contains(at("more"), at("block"))
    uses = F.when(partial & (at("passes") > last), last).otherwise(last - 1)
    used = joined.withColumn(own + "epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), uses.cast("bigint"))))
    slot = (at("epoch") + _rank(m, at("source_key"), at("block"), at("epoch"))) / at("passes")
    made = {"mix_weight": at("weight"), "mix_epoch": at("epoch"), "mix_block": at("block"), "mix_slot": slot}
    return used.select(*[c for c in docs.columns if c not in made], *[v.alias(k) for k, v in made.items()])


def mixed_documents(docs: DataFrame, m: Mixing = Mixing()) -> DataFrame:
    """Documents as often as the mixture uses them, with their own columns, dealt out and sorted by mix_slot.

    So every file of the result, and their order, holds the mixture; slots are hashes, and thus no range of them is hot.
    """
    clashing = {c: f"_{c}" for c in docs.columns if c.startswith("mix_")}
    mixed = mix(docs.withColumnsRenamed(clashing), m)
    ordered = mixed.repartitionByRange("mix_slot", F.xxhash64("doc_id")).sortWithinPartitions("mix_slot", F.xxhash64("doc_id"))
    return ordered.select(*[F.col(clashing.get(c, c)).alias(c) for c in docs.columns])
