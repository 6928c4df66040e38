"""Language identification: multinomial logistic regression on TF-IDF character n-grams, FTRL with elastic net."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.common import blocks, code_points, segment_sums, texts

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """train_rows bounds the labelled rows that fit the classifier; document frequencies cover all labelled rows."""

    bits: int = 14
    orders: tuple[int, ...] = (1, 2, 3)
    train_rows: int = 2000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05
    scale: float = 20.0
    calibration_share: float = 0.25


_letters: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """Code point of the lower-case letter; a blank for all that is no letter."""
    if not _letters:
        _letters.append(np.array([ord(c.lower()[0]) if (c := chr(p)).isalpha() else 32 for p in range(0x110000)], np.uint32))
    return _letters[0]


def _buckets(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that ends at each position."""
    h = np.full(len(points), 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
    for j in range(n):
        shifted = points if j == 0 else np.concatenate([np.zeros(j, np.uint32), points[:-j]])
        h = (h ^ shifted) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)


def _positions(found: list[str], p: Params) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    points, starts, ends = code_points(found, max(p.orders))
    folded = _folded()[points]
    letters = segment_sums((folded != 32).astype(np.int64), starts, ends)
    return [_buckets(folded, n, p.bits) for n in p.orders], starts, ends, letters


def document_frequencies(train: DataFrame, p: Params) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all labelled documents, and their number."""
    size = 1 << p.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size + 1, np.int64), 0
        for _, data, offsets in blocks(batches):
            hs, starts, ends, _ = _positions(texts(data, offsets), p)
            for a, b in zip(starts.tolist(), ends.tolist()):
                mark = np.zeros(size, bool)
                for h in hs:
                    mark[h[a:b]] = True
                df[:-1] += mark
                n += 1
        df[-1] = n
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], ["bucket", "n"])

    got = train.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(size + 1, np.int64)
    df[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return df[:-1], int(df[-1])


def _sample(train: DataFrame, p: Params) -> tuple[list[str], DataFrame]:
    """Of each language the rows least in a hash of doc_id and text, equally many, train_rows at most over all.

    Neither the layout of the table nor the order of its rows has a part in it. The share drawn by the hash only spares
    the ranking of rows that are far behind.
    """
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return langs, train.limit(0)
    each = max(1, p.train_rows // len(langs))
    share = F.lit(0.0)
    for lang in langs:
        # Ten deviations more than wanted, so that fewer than wanted are not drawn.
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, (each + 10 * each**0.5 + 10) / counts[lang]))).otherwise(share)
    drawn = train.withColumn("draw", F.xxhash64(F.lit(17), "doc_id", "text"))
    near = drawn.where(F.pmod("draw", F.lit(1 << 30)) / float(1 << 30) < share)
    # Copies of one row have one draw: at most `each` rows of a task get beyond the planner's limit on ranks.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(1 << 30)), "draw", "doc_id"))
    return langs, near.withColumn("nth", rank).where(F.col("nth") <= each).select("text", "lang")


def _features(sample: DataFrame, p: Params) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, buckets, relative frequencies); bounded by train_rows times 2^bits entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            hs, starts, ends, letters = _positions(texts(data, offsets), p)
            out = []
            for lang, a, b, k in zip(rows.column("lang").to_pylist(), starts.tolist(), ends.tolist(), letters.tolist()):
                if k:
                    ids, n = np.unique(np.concatenate([h[a:b] for h in hs]), return_counts=True)
                    out.append((lang, ids.astype(np.uint32).tobytes(), (n / (b - a)).astype(np.float32).tobytes()))
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], ["lang", "ids", "tf"])

    got = sample.select("lang", "text").mapInArrow(run, "lang string, ids binary, tf binary").collect()
    rows = [(r["lang"], np.frombuffer(r["ids"], np.uint32), np.frombuffer(r["tf"], np.float32)) for r in got]
    return sorted(rows, key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_langs: int, size: int, p: Params) -> np.ndarray:
    """Weights (size + 1, languages); the last row is the bias. One pass of FTRL-proximal updates per epoch."""
    z, n, w = (np.zeros((size + 1, n_langs)) for _ in range(3))
    rng = np.random.default_rng(3)
    for _ in range(p.epochs):
        for k in rng.permutation(len(rows)):
            y, ids, x = rows[k]
            error = _softmax(x @ w[ids])
            error[y] -= 1
            g = x[:, None] * error[None, :]
            old = n[ids]
            new = old + g * g
            z[ids] += g - (np.sqrt(new) - np.sqrt(old)) / p.alpha * w[ids]
            n[ids] = new
            zi = z[ids]
            w[ids] = np.where(np.abs(zi) <= p.l1, 0.0, -(zi - np.sign(zi) * p.l1) / ((p.beta + np.sqrt(new)) / p.alpha + p.l2))
    return w


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Minimises the log loss of softmax(logits / t) by golden sections over log t."""

    def loss(u: float) -> float:
        q = _softmax(logits / np.exp(u))
        return float(-np.log(np.maximum(q[np.arange(len(y)), y], 1e-12)).mean())

    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    langs: list[str]
    #: idf times weight of each bucket and language.
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def fit(train: DataFrame, p: Params = Params()) -> Model:
    """train: doc_id, text and non-null lang."""
    df, n = document_frequencies(train, p)
    idf = np.log((1 + n) / (1 + df)) + 0.1
    langs, sample = _sample(train, p)
    size = 1 << p.bits
    code = {lang: k for k, lang in enumerate(langs)}
    rows = [(code[lang], np.append(ids, size).astype(np.int64), np.append(tf * idf[ids] * p.scale, 1.0)) for lang, ids, tf in _features(sample, p)]
    order = np.random.default_rng(5).permutation(len(rows))
    cut = int(len(rows) * p.calibration_share)
    own, rest = [rows[k] for k in order[:cut]], [rows[k] for k in order[cut:]]
    w = fit_ftrl(rest, len(langs), size, p)
    t = temperature(np.stack([x @ w[ids] for _, ids, x in own]), np.array([y for y, *_ in own])) if own else 1.0
    return Model(langs, (w[:-1] * idf[:, None] * p.scale).astype(np.float32), w[-1], t)


def predict(docs: DataFrame, model: Model, keys: list[str], p: Params = Params()) -> DataFrame:
    """keys, lang_pred and score. Reads the text alone; null texts and texts without a letter are und with score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows, data, offsets in blocks(batches):
            found = texts(data, offsets)
            hs, starts, ends, letters = _positions(found, p)
            if m.langs:
                logits = np.zeros((len(found), len(m.langs)))
                for k in range(len(m.langs)):
                    own = np.ascontiguousarray(m.weights[:, k])
                    for h in hs:
                        logits[:, k] += segment_sums(own[h], starts, ends)
                q = _softmax((logits / np.maximum(ends - starts, 1)[:, None] + m.bias) / m.temperature)
                best, sure = q.argmax(1), q.max(1)
                names = [m.langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), letters.tolist())]
                sure = np.where(letters > 0, sure, 0.0)
            else:
                names, sure = [UNKNOWN] * len(found), np.zeros(len(found))
            cols = [rows.column(k) for k in keys] + [pa.array(names, pa.string()), pa.array(sure, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, [*keys, "lang_pred", "score"])

    return docs.select(*keys, "text").mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def identify(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Learns from labelled documents outside the held-out fold.

    Without any such document, and for null, empty and letterless texts, the prediction is und. Very long texts are read
    whole. A null doc_id counts as not held out. Repeated rows and equal texts are predicted alike; of equally probable
    languages the first by name is taken. An empty table gives no rows. Only doc_id, text and lang are read, so other
    columns may have any name.
    """
    fold = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    train = docs.where(~fold & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    model = fit(train, p)
    return predict(docs.select("doc_id", "text", fold.alias("held_out")), model, ["doc_id", "held_out"], p)
