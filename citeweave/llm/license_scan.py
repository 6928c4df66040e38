"""License scans: phrases, and templates that a block of text contains to a threshold, by an exact set-similarity join.

Blocks are windows of a text's words, twice as wide as the templates that are looked for in them and half a window apart,
so that a whole notice lies in one. Tokens stand in one order of their frequency in the whole table, rare ones first. A
block and a template whose sets share enough share a token of both prefixes; lengths and positions rule out most others,
and what is left is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import blocks

# Phrases whose places are counted, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Usual notices, as (label, words). Several may have one label.
TEMPLATES = (
    ("agpl", "gnu affero general public license version"),
    ("apache", "licensed under the apache license version"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by", "licensed under a creative commons attribution international license"),
    ("gpl", "licensed under the gnu general public license version"),
    ("lgpl", "gnu lesser general public license version"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("proprietary", "no part of this publication may be reproduced in any form without prior written permission"),
)

#: Tokens of all templates that are broadcast at most (about 100 bytes each); more are refused.
MAX_TOKENS = 1_000_000

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Scan:
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    phrases: tuple[tuple[str, str], ...] = PHRASES
    #: Share of a template's distinct words that a block holds at least.
    percent: int = 85


def words_of(text: bytes) -> list[bytes]:
    """Runs of a-z, 0-9 and characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_WORDS).split()


def needed(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def block_width(template: str) -> int:
    """Words of the blocks in which a template is looked for: a power of two, so that a notice of its length lies in one."""
    return 2 << max(len(words_of(template.encode())) - 2, 0).bit_length()


@dataclass
class Index:
    """Templates of one block width, by the tokens of their prefixes."""

    width: int
    #: (label, tokens in the common order, tokens that a block has to hold)
    templates: list[tuple[str, list[int], int]]
    #: token -> (template, place in it)
    prefixes: dict[int, list[tuple[int, int]]]
    in_prefix: np.ndarray

    def matches(self, block: list[int]) -> list[tuple[int, int]]:
        """(template, shared tokens) of the templates that a block holds. block: distinct tokens in the common order."""
        shared: dict[int, int] = {}
        for j, token in enumerate(block):
            for t, i in self.prefixes.get(token, ()):
                _, tokens, need = self.templates[t]
                if len(block) < need or j > len(block) - need and t not in shared:
                    continue  # too short, or behind the block's own prefix
                so_far = shared.get(t, 0)
                if so_far >= 0:
                    ahead = min(len(tokens) - i, len(block) - j)
                    shared[t] = so_far + 1 if so_far + ahead >= need else -1
        held = set(block)
        found = [(t, sum(x in held for x in self.templates[t][1])) for t, n in shared.items() if n > 0]
        return [(t, n) for t, n in found if n >= self.templates[t][2]]


@dataclass
class Prepared:
    #: word -> rank: rare ones first.
    ranks: dict[bytes, int]
    indexes: list[Index]
    phrases: list[tuple[str, list[int]]]


def prepare(scan: Scan, counts: dict[bytes, int]) -> Prepared:
    """counts: occurrences of the words in the whole table; a word that is missing has none."""
    vocabulary = vocabulary_of(scan)
    ranks = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    indexes = []
    for width in sorted({block_width(t) for _, t in scan.templates}):
        templates, prefixes = [], {}
        for label, text in scan.templates:
            tokens = sorted({ranks[w] for w in words_of(text.encode())})
            if block_width(text) == width and tokens:
                need = needed(len(tokens), scan.percent)
                for i, token in enumerate(tokens[: len(tokens) - need + 1]):
                    prefixes.setdefault(token, []).append((len(templates), i))
                templates.append((label, tokens, need))
        in_prefix = np.zeros(len(ranks) + 1, bool)
        in_prefix[list(prefixes)] = True
        indexes.append(Index(width, templates, prefixes, in_prefix))
    return Prepared(ranks, indexes, [(label, [ranks[w] for w in words_of(p.encode())]) for p, label in scan.phrases])


def vocabulary_of(scan: Scan) -> list[bytes]:
    if not 0 < scan.percent <= 100:
        raise ValueError("percent lies between 1 and 100")
    found = {w for x in (*[t for _, t in scan.templates], *[p for p, _ in scan.phrases]) for w in words_of(x.encode())}
    if len(found) > MAX_TOKENS:
        raise ValueError(f"templates have at most {MAX_TOKENS} different words")
    return sorted(found)


def _ranked(data: np.ndarray, offsets: np.ndarray, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every word of a block of texts (-1 for other words), and words before each text."""
    raw, at, found, before = data.tobytes().translate(_WORDS), offsets.tolist(), [], [0]
    get = ranks.get
    for a, b in zip(at, at[1:]):
        found += [get(w, -1) for w in raw[a:b].split()]
        before.append(len(found))
    return np.array(found, np.int64), np.array(before)


def word_counts(docs: DataFrame, scan: Scan) -> dict[bytes, int]:
    """Occurrences of the templates' words in all texts: at most MAX_TOKENS numbers."""
    ranks = {w: k for k, w in enumerate(vocabulary_of(scan))}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ranks) + 1, np.int64)
        for _, data, offsets in blocks(batches):
            total += np.bincount(_ranked(data, offsets, ranks)[0] + 1, minlength=len(total))
        seen = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen + 1], pa.int64())], ["word", "n"])

    got = docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    names = list(ranks)
    return {names[r["word"]]: r["n"] for r in got}


def _phrase_places(ids: np.ndarray, text_of: np.ndarray, phrases: list[tuple[str, list[int]]]) -> list[np.ndarray]:
    """Places at which each phrase begins; it ends in the same text."""
    out = []
    for _, words in phrases:
        n = max(len(ids) - len(words) + 1, 0)
        met = np.ones(n, bool)
        for k, w in enumerate(words):
            met &= ids[k : k + n] == w
        at = np.flatnonzero(met)
        out.append(at[text_of[at] == text_of[at + len(words) - 1]])
    return out


def _blocks_found(ids: np.ndarray, before: np.ndarray, text_of: np.ndarray, index: Index) -> Iterator[tuple[int, dict]]:
    """(text, block) of every block that holds a template."""
    hits = np.flatnonzero(index.in_prefix[ids])
    stride = index.width // 2
    nth = (hits - before[text_of[hits]]) // stride
    near = np.unique(np.stack([np.tile(text_of[hits], 2), np.concatenate([nth, nth - 1])]), axis=1)
    for text, q in near[:, near[1] >= 0].T.tolist():
        start = before[text] + q * stride
        end = min(start + index.width, before[text + 1])
        held = np.unique(ids[start:end])
        for t, n in index.matches([x for x in held.tolist() if x >= 0]):
            label, tokens, _ = index.templates[t]
            yield text, {"label": label, "first_word": q * stride, "n_words": int(end - start), "containment": n / len(tokens)}


_BLOCK = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())])
_FOUND = {
    "doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double",
    "blocks": "array<struct<label string, first_word bigint, n_words bigint, containment double>>",
}


def scan_licenses(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """doc_id, n_words, the places of the phrases, labels, score, and blocks: each block that holds a template.

    Two narrow passes over the texts, one to count the templates' words and one to look for them; no row moves. score is
    1 with a phrase, else the largest share of a template that a block holds, 0 without any. Null and empty texts have
    no words, no labels (empty strings) and a score of 0. Null doc_ids stay null; repeated rows get equal results; a
    very long text is scanned whole, window by window. An empty table gives no rows. Of docs only doc_id and text
    are read, so other columns may have any name.
    """
    prepared = docs.sparkSession.sparkContext.broadcast(prepare(scan, word_counts(docs, scan)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = prepared.value
        for rows, data, offsets in blocks(batches):
            ids, before = _ranked(data, offsets, p.ranks)
            text_of = np.repeat(np.arange(len(rows)), np.diff(before))
            base, places, found = [set() for _ in range(len(rows))], [], [[] for _ in range(len(rows))]
            for (label, _), at in zip(p.phrases, _phrase_places(ids, text_of, p.phrases)):
                places.append(at)
                for t in np.unique(text_of[at]).tolist():
                    base[t].add(label)
            for index in p.indexes:
                for t, block in _blocks_found(ids, before, text_of, index):
                    found[t].append(block)
            at = np.sort(np.concatenate([*places, np.zeros(0, np.int64)]))
            edges = np.searchsorted(at, before)
            n_base, n = np.diff(edges), len(at)
            none = n_base == 0
            first, last = (np.append(at, 0)[np.clip(e, 0, n)] - before[:-1] for e in (edges[:-1], edges[1:] - 1))
            labels = [",".join(sorted(b | {x["label"] for x in f})) for b, f in zip(base, found)]
            score = [1.0 if b else max((x["containment"] for x in f), default=0.0) for b, f in zip(base, found)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), pa.array(np.diff(before)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                    pa.array([",".join(sorted(b)) for b in base], pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()), pa.array(found, pa.list_(_BLOCK)),
                ],
                list(_FOUND),
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _FOUND.items()))


def license_blocks(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """One row per text block and template that it holds: doc_id, label, first_word, n_words, containment."""
    return scan_licenses(docs, scan).select("doc_id", F.explode("blocks").alias("b")).select("doc_id", "b.*")
