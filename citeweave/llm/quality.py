"""Quality rules: base counts, and bands on the perplexity of a modified Kneser-Ney model of each language.

The model is over character n-grams of five, of every character that the corpus has (digits are one, white space is
another). Spark counts them over all documents and estimates each order by joins, so the model grows with the corpus.
For scoring it is dealt into slices of bounded size, each a sorted hash array that is broadcast; a text's sum adds up
over them. Probabilities and sums are whole numbers, so equal texts have equal perplexities.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from citeweave.llm.common import blocks, code_points, mix64, segment_sums, store, texts, windows, word_hashes

ORDER = 5
#: Log-probabilities are stored in parts of a nat.
UNIT = 1 << 20
LM_BLOCK = 1 << 20
#: Text bytes whose n-grams a worker adds up before it hands them on.
COUNTED_BYTES = 1 << 22
#: n-grams of a slice of the model, 12 bytes each.
SLICE = 1 << 22


@dataclass(frozen=True)
class Bands:
    """A document passes from q25 - below * spread to q75 + above * spread of its language's log-perplexities a symbol.

    The quartiles are exact, of values in thousandths of a nat. spread is their range, at least floor nats (many copies
    of one text would make it 0). Texts of few words and of repeats are clean more often than improbable ones, so the
    band is wider below.
    """

    below: float = 4.0
    above: float = 3.0
    floor: float = 0.02


@cache
def _folded() -> np.ndarray:
    """One digit and one blank; case stays, as shouting is improbable text."""
    table = np.arange(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isdecimal():
            table[point] = 48
        elif c.isspace():
            table[point] = 32
    return table


@cache
def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _hashes(columns: list[np.ndarray], seeds: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams, whose symbols are the columns, in a language's model."""
    h = seeds.copy()
    for c in columns:
        h = h * np.uint64(0x9FB21C651E98DF25) + c.astype(np.uint64)
    return mix64(h)


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([_seed(x) for x in langs], np.uint64)


def _positions(found: list[str], langs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded symbols; of every symbol of a text, its position and its n-gram's hash; how many each text has."""
    points, starts, ends = code_points(found, ORDER - 1)
    points = _folded()[points]
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    at = np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))
    hashed = _hashes([points[at - ORDER + 1 + j] for j in range(ORDER)], np.repeat(_seeds(langs), sizes))
    return points, at, hashed, sizes


def _strings(symbols: np.ndarray) -> pa.StringArray:
    """One string a row of code points."""
    width = 1 + (symbols >= 0x80).astype(np.int32) + (symbols >= 0x800) + (symbols >= 0x10000)
    offsets = np.zeros(len(symbols) + 1, np.int32)
    np.cumsum(width.sum(1), out=offsets[1:])
    raw = np.ascontiguousarray(symbols, "<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(symbols), pa.py_buffer(offsets), pa.py_buffer(raw))


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all documents, added up within tasks first. A text begins behind null characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def added() -> pa.RecordBatch:
            h, n, own, symbols = (np.concatenate(x) for x in zip(*held))
            by = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.diff(h[by], prepend=~h[by[:1]]))
            langs = pa.array(list(number), pa.string()).take(pa.array(own[by[first]]))
            return pa.RecordBatch.from_arrays([langs, _strings(symbols[by[first]]), pa.array(np.add.reduceat(n[by], first))], ["lang", "gram", "n"])

        for rows, data, offsets in blocks(batches, LM_BLOCK):
            langs = rows.column("lang").to_pylist()
            points, at, h, sizes = _positions(texts(data, offsets), langs)
            if not len(h):
                continue
            by = np.argsort(h)
            first = np.flatnonzero(np.diff(h[by], prepend=~h[by[:1]]))
            n, one = np.diff(first, append=len(h)), by[first]
            own = np.repeat([number.setdefault(x, len(number)) for x in langs], sizes)
            held.append((h[one], n, own[one], points[at[one][:, None] + np.arange(1 - ORDER, 1)]))
            size += len(data)
            if size >= COUNTED_BYTES:
                yield added()
                held, size = [], 0
        if held:
            yield added()

    kept = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return kept.mapInArrow(run, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discount(k: int) -> Column:
    """Of counts of k, from counts of counts; 0.5 where these give none."""
    n = [F.col(f"n{j}").cast("double") for j in (1, 2, 3, 4)]
    given = F.lit(float(k)) - (k + 1) * (n[0] / (n[0] + 2 * n[1])) * n[k] / n[k - 1]
    return F.when(F.least(*n) > 0, F.least(F.greatest(given, F.lit(0.05)), F.lit(k - 0.05))).otherwise(0.5).alias(f"d{k}")


def _of_count(n: Column, values: list[Column]) -> Column:
    return F.when(n < 1, 0.0).when(n == 1, values[0]).when(n == 2, values[1]).otherwise(values[2])


def estimate(counts: DataFrame) -> DataFrame:
    """(lang, gram, logp): interpolated modified Kneser-Ney of every counted n-gram, logp in parts of a nat.

    Lower orders count distinct left neighbours. Below single symbols all symbols of the language, and one that was
    never seen, are equally probable. The model judges the texts that it is counted from, so each n-gram's probability
    is that without one occurrence of it: one that is nowhere else counts as unseen, in every order where that was its
    only one, and nonsense does not vouch for itself.
    """
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = store(levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    lower = None
    for k in range(1, ORDER + 1):
        n = F.col("n")
        # Written first: one row a language, so the planner sees its size.
        found = levels[k].groupBy("lang").agg(*[F.count_if(n == j).alias(f"n{j}") for j in (1, 2, 3, 4)])
        discounts = store(found.select("lang", *[_discount(j) for j in (1, 2, 3)]))
        begun = F.substring("gram", 1, k - 1).alias("begun")
        totals = F.sum("n").alias("total")
        kinds = [F.count_if(x).alias(a) for a, x in (("k1", n == 1), ("k2", n == 2), ("k3", n >= 3))]
        contexts = levels[k].groupBy("lang", begun).agg(totals, *kinds)
        d = [F.col(f"d{j}") for j in (1, 2, 3)]
        mass = d[0] * F.col("k1") + d[1] * F.col("k2") + d[2] * F.col("k3")
        grams = levels[k].select("lang", "gram", "n", begun).join(discounts, "lang").join(contexts, ["lang", "begun"])
        if lower is None:
            seen = F.col("k1") + F.col("k2") + F.col("k3")
            grams = grams.withColumns({"below": 1.0 / (seen + 1), "below_without": 1.0 / (seen + 1)})
        else:
            grams = grams.withColumn("ended", F.substring("gram", 2, k - 1)).join(lower, ["lang", "ended"])
        total, below, bare = F.col("total"), F.col("below"), F.col("below_without")
        p = (F.greatest(n - _of_count(n, d), F.lit(0.0)) + mass * below) / total
        # One occurrence less: the context loses it too, and the order below loses a neighbour if it was the only one.
        less = _of_count(n - 1, d)
        rest = (F.greatest(n - 1 - less, F.lit(0.0)) + (mass - _of_count(n, d) + less) * F.when(n == 1, bare).otherwise(below)) / (total - 1)
        without = F.when(total == 1, bare).otherwise(rest)
        if k < ORDER:
            lower = store(grams.select("lang", F.col("gram").alias("ended"), p.alias("below"), without.alias("below_without")))
    return store(grams.select("lang", "gram", F.round(F.log(without) * UNIT).cast("int").alias("logp")))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The model of all documents, as a table."""
    return estimate(store(count_grams(docs, text, lang)))


class Slice:
    """Hashes of n-grams in ascending order, log-probabilities beside them, and where each beginning of a hash starts."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray):
        by = np.argsort(keys)
        self.keys, self.logp = keys[by], logp[by].astype(np.int32)
        self.shift = 64 - max(4, int(len(keys)).bit_length() - 1)
        heads = np.arange(1 << (64 - self.shift), dtype=np.uint64) << np.uint64(self.shift)
        self.first = np.searchsorted(self.keys, heads).astype(np.int32)

    @classmethod
    def of(cls, part: pa.Table) -> Slice:
        if not part.num_rows:
            return cls(np.zeros(0, np.uint64), np.zeros(0, np.int32))
        points = np.frombuffer("".join(part.column("gram").to_pylist()).encode("utf-32-le"), "<u4").reshape(-1, ORDER)
        coded = part.column("lang").combine_chunks().dictionary_encode()
        seeds = _seeds(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        return cls(_hashes(list(points.T), seeds), part.column("logp").to_numpy())

    def find(self, hashed: np.ndarray) -> np.ndarray:
        """Log-probability of each n-gram; 0 for those of other slices."""
        out = np.zeros(len(hashed), np.int64)
        if not len(self.keys):
            return out
        at = self.first[(hashed >> np.uint64(self.shift)).astype(np.int64)]
        left = np.arange(len(hashed))
        while len(left):
            inside = at < len(self.keys)
            left, at = left[inside], at[inside]
            key, wanted = self.keys[at], hashed[left]
            hit = key == wanted
            out[left[hit]] = self.logp[at[hit]]
            more = key < wanted
            left, at = left[more], at[more] + 1
        return out


_SYMBOL = np.zeros(256, np.int64)
# The characters counted as symbols.
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_LETTERS = np.ones(256, np.int64)
_LETTERS[[9, 10, 11, 12, 13, 32]] = 0
_LETTERS[128:192] = 0
_BLANK = " \t\n\v\f\r"


def _repeated_words(words: np.ndarray, k: int = 3) -> int:
    """Words inside windows of k words that the document holds twice or more."""
    if len(words) <= k:
        return 0
    h = windows(words, k)
    by = np.argsort(h, kind="stable")
    same = h[by[1:]] == h[by[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(len(words) + k, np.int32)
    at = np.unique(np.concatenate([by[1:][same], by[:-1][same]]))
    for j in range(k):
        covered[at + j] = 1
    return int(covered.sum())


def _repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


def score(docs: DataFrame, model: DataFrame, keys: list[str], text: str = "text", lang: str = "lang", entries: int = SLICE) -> DataFrame:
    """keys, then n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and log_perplexity a symbol (null without words).

    The model has to hold every n-gram of the texts. It comes by slices of about `entries` n-grams; with more than one,
    the texts are written with their sums so far between them.
    """
    spark, names = docs.sparkSession, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    slices = max(1, -(-model.count() // entries))

    def summed(part: Slice, found: list[str], langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        _, _, hashed, sizes = _positions(found, langs)
        ends = np.cumsum(sizes)
        return segment_sums(part.find(hashed), ends - sizes, ends), sizes

    def add(shared, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, data, offsets in blocks(batches):
                found, langs = texts(data, offsets), rows.column("lang").to_pylist()
                total, symbols = summed(shared.value, found, langs)
                if first:
                    hashes, before = word_hashes(data, offsets, False)
                    counted = [segment_sums(t[data], offsets[:-1], offsets[1:]) for t in (_LETTERS, _SYMBOL)]
                    lines = [_repeated_lines(t) for t in found]
                    repeats = [_repeated_words(hashes[a:b]) for a, b in zip(before.tolist(), before.tolist()[1:])]
                    made = [np.diff(before), *counted, lines, repeats, symbols, total]
                    cols = [*rows.columns, *[pa.array(np.asarray(v, np.int64)) for v in made]]
                else:
                    cols = [*rows.columns[:-1], pa.array(rows.column("total").to_numpy() + total)]
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

        return run

    out = docs.select(*[F.col(k) for k in keys if k not in (text, lang)], F.col(lang).alias("lang"), F.col(text).alias("text"))
    fields = StructType(out.schema.fields + [StructField(x, LongType()) for x in [*names, "symbols", "total"]])
    for k in range(slices):
        part = model.where(F.pmod(F.xxhash64("lang", "gram"), F.lit(slices)) == k)
        shared = spark.sparkContext.broadcast(Slice.of(part.toArrow()))
        out = (store(out) if k else out).mapInArrow(add(shared, k == 0), fields)
    mean = F.when(F.col("n_words") > 0, -F.col("total") / (F.col("symbols") * F.lit(float(UNIT))))
    return out.select(*[F.col("lang" if k == lang else "text" if k == text else k).alias(k) for k in keys], *names, mean.alias("log_perplexity"))


def _judged(scored: DataFrame, bands: Bands) -> DataFrame:
    """Adds base_failed, kept and the band to scored rows. The bands, one row a language, join back."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    # Thousandths, counted first: what a language's quartiles gather has a bound.
    binned = scored.where(~F.col("base_failed")).groupBy("lang", F.round("log_perplexity", 3).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    q = binned.groupBy("lang").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"))
    spread = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(bands.floor))
    # Written first: one row a language, so the planner sees its size and no document is dealt out by language.
    limits = store(q.select("lang", (F.col("q")[0] - bands.below * spread).alias("lower"), (F.col("q")[1] + bands.above * spread).alias("upper")))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return scored.join(limits, "lang", "left").withColumn("kept", ~F.col("base_failed") & inside)


def judge(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: counts, base_failed, kept, perplexity and its language's band.

    Null and empty texts have no words, fail the base rules and are not kept. A null language (one with the empty one)
    has a model and a band of its own. Very long texts are judged whole; equal texts of one language have equal
    perplexities, so repeated rows are judged alike, and a value at an edge of its band passes. Columns other than doc_id,
    text and lang are not read. An empty table gives no rows.
    """
    keyed = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "text")
    scored = store(score(keyed, train(keyed), ["doc_id", "lang"]))
    return _judged(scored, bands).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.exp("log_perplexity").alias("perplexity"), F.exp("lower").alias("lower_perplexity"), F.exp("upper").alias("upper_perplexity"),
    )


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, with all their columns. Documents are scored once; none is shuffled."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    keyed = docs.select(rest, F.coalesce("lang", F.lit("")).alias("lang"), "text")
    scored = store(score(keyed, train(keyed), ["row", "lang", "text"]))
    kept = _judged(scored, bands).where("kept")
    return kept.select(*[kept["text"] if c == "text" else kept["row"][c].alias(c) for c in docs.columns])
