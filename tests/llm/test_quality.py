"""Base counts, the language model and the bands against plain versions."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import quality
from citeweave.llm.catalogue import op1_quality_rules

from .common import awkward, empty, words


def plain_counts(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) for j in range(3) if grams[tuple(w[i : i + 3])] > 1}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_counts(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        made = plain_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in COUNTS) == made
        assert r["base_failed"] == (made[0] < 50 or 100 * made[4] > 50 * made[0])
        assert not (r["kept"] and r["base_failed"])
        if not r["base_failed"]:
            assert r["kept"] == (r["lower_perplexity"] <= r["perplexity"] <= r["upper_perplexity"]) or math.isclose(r["perplexity"], r["upper_perplexity"]) or math.isclose(r["perplexity"], r["lower_perplexity"])


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = quality.judge(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    assert all(tuple(r[c] for c in COUNTS) == plain_counts(texts[r["doc_id"]]) for r in rows)
    assert quality.judge(empty(spark)).count() == 0
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(empty(spark)).count() == 0


def folded(text):
    return "".join("0" if c.isdecimal() else " " if c.isspace() else c for c in text)


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney over dictionaries: probability of a symbol behind a context of order - 1."""
    top = Counter()
    for t in texts:
        s = "\0" * (order - 1) + folded(t)
        top.update(s[i : i + order] for i in range(len(s) - order + 1))
    levels = [top]
    while len(levels) < order:
        levels.insert(0, Counter(g[1:] for g in levels[0]))

    def discounts(counts):
        n = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        if min(n) <= 0:
            return [0, 0.5, 0.5, 0.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]

    known = []
    for c in levels:
        d, by = discounts(c), defaultdict(Counter)
        for g, v in c.items():
            by[g[:-1]][g[-1]] = v
        known.append((d, by))

    def probability(gram, without=False):
        """From the followers of each context; without one occurrence of the n-gram where asked."""
        k = len(gram)
        if not k:
            return 1 / (len(levels[0]) + 1)
        d, by = known[k - 1]
        followers = by.get(gram[:-1], Counter())
        n = followers[gram[-1]]
        changed = {gram[-1]: n - 1} if without else {}
        counts = [v for c, v in followers.items() if c not in changed] + list(changed.values())
        lower = probability(gram[1:], without and n == 1)
        if not sum(counts):
            return lower
        own = n - without
        return (max(own - d[min(own, 3)], 0) + sum(d[min(v, 3)] for v in counts) * lower) / sum(counts)

    return probability


@pytest.fixture(scope="module")
def few(spark, sf_dir):
    """Documents of four languages and one in other scripts, which has symbols of one to four bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 70").select("doc_id", "lang", "text")
    other = "語言模型也要認識漢字。Ω 123 😀\0x\n" * 20
    return [tuple(r) for r in docs.collect()] + [(900, "zh", other), (901, "zh", other[3:]), (902, "zh", None)]


def by_lang(rows):
    out = defaultdict(list)
    for _, lang, text in rows:
        out[lang].append(text or "")
    return {lang: plain_model(found, quality.ORDER) for lang, found in out.items()}


def test_model_equals_a_plain_one(spark, few):
    docs = spark.createDataFrame(few, "doc_id bigint, lang string, text string")
    rows, plain = quality.train(docs).collect(), by_lang(few)
    assert len({(r["lang"], r["gram"]) for r in rows}) == len(rows)
    wanted = set()
    for _, lang, text in few:
        s = "\0" * (quality.ORDER - 1) + folded(text or "")
        wanted.update((lang, s[i : i + quality.ORDER]) for i in range(len(s) - quality.ORDER + 1))
    assert {(r["lang"], r["gram"]) for r in rows} == wanted
    assert all(abs(r["logp"] / quality.UNIT - math.log(plain[r["lang"]](r["gram"], True))) < 1e-5 for r in rows)


def test_plain_probabilities_add_up():
    p = plain_model(["abracadabra", "barbara", "cadabra"], 3)
    for context in ("\0\0", "br", "ra"):
        assert sum(p(context + c) for c in "abrcd") + p(context + "z") == pytest.approx(1)


def test_verdicts_equal_plain_ones(spark, few):
    """Perplexities, quartiles and verdicts of whole texts, from dictionaries."""
    plain, scores = by_lang(few), {}
    for d, lang, text in few:
        s = "\0" * (quality.ORDER - 1) + folded(text or "")
        logs = [math.log(plain[lang](s[i : i + quality.ORDER], True)) for i in range(len(s) - quality.ORDER + 1)]
        scores[d] = (lang, -sum(logs) / len(logs) if words(text) else None)
    rows = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(few, "doc_id bigint, lang string, text string")).collect()}
    bands, values = quality.Bands(), defaultdict(list)
    for d, (lang, v) in scores.items():
        if not rows[d]["base_failed"]:
            values[lang].append(round(v, 3))
    for d, (lang, v) in scores.items():
        r = rows[d]
        assert (r["perplexity"] is None) if v is None else r["perplexity"] == pytest.approx(math.exp(v), rel=1e-4)
        if lang in values:
            q25, q75 = np.quantile(values[lang], [0.25, 0.75])
            spread = max(q75 - q25, bands.floor)
            lower, upper = q25 - bands.below * spread, q75 + bands.above * spread
            assert math.log(r["lower_perplexity"]) == pytest.approx(lower, abs=1e-2) and math.log(r["upper_perplexity"]) == pytest.approx(upper, abs=1e-2)
        assert r["kept"] == (not r["base_failed"] and math.log(r["lower_perplexity"]) - 1e-9 <= math.log(r["perplexity"]) <= math.log(r["upper_perplexity"]) + 1e-9)


def test_slices_of_any_size_give_the_same_sums(spark, few):
    docs = spark.createDataFrame(few, "doc_id bigint, lang string, text string")
    model = quality.train(docs)
    one, many = (sorted(quality.score(docs, model, ["doc_id", "lang", "text"], entries=k).collect()) for k in (quality.SLICE, model.count() // 3))
    assert one == many


def test_the_model_grows_with_the_corpus(spark, few):
    sizes = [quality.train(spark.createDataFrame(few[:k], "doc_id bigint, lang string, text string")).count() for k in (15, 30, 60)]
    assert sizes[0] < sizes[1] < sizes[2]


def test_foreign_and_garbled_texts_go(spark, sf_dir):
    """Texts of another language, and texts of shuffled letters, under a language's model."""
    import random

    r = random.Random(3)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang IN ('en', 'de') AND size(split(text, ' ')) > 80").select("doc_id", "lang", "text").collect()
    english = [(d["doc_id"], "en", d["text"]) for d in docs if d["lang"] == "en"]
    foreign = [(10_000 + k, "en", d["text"]) for k, d in enumerate([d for d in docs if d["lang"] == "de"][:3])]
    garbled = [(20_000 + k, "en", "".join(r.sample(t, len(t)))) for k, (_, _, t) in enumerate(english[:3])]
    rows = quality.judge(spark.createDataFrame(english + foreign + garbled, "doc_id bigint, lang string, text string")).collect()
    kept = {x["doc_id"] for x in rows if x["kept"]}
    assert not any(d >= 20_000 for d in kept)
    assert not any(10_000 <= d < 20_000 for d in kept)
    failed = {x["doc_id"] for x in rows if x["base_failed"]}
    assert len(kept) > 0.95 * sum(d not in failed for d, _, _ in english)


def test_strange_documents_go_and_clean_ones_stay(spark):
    import random

    r = random.Random(5)
    vocabulary = ["".join(r.choice("aeinrst") for _ in range(r.randint(2, 7))) for _ in range(300)]
    clean = [(k, " ".join(r.choice(vocabulary) for _ in range(120)), "xx") for k in range(200)]
    strange = [(1000 + k, " ".join("".join(r.choice("QZ#@78<>wk") for _ in range(6)) for _ in range(120)), "xx") for k in range(4)]
    kept = {d["doc_id"] for d in quality.judge(spark.createDataFrame(clean + strange, "doc_id bigint, text string, lang string")).where("kept").collect()}
    assert kept == set(range(200))


def test_keep_good_agrees_with_judge(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == kept
    assert good.exceptAll(docs).count() == 0
    assert good.where(F.col("text").isNull()).count() == 0
