"""Token ids by the tokenizers library, with a bounded cache of words."""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are encoded at once: the larger, the fewer pieces are different.
ENCODED_BYTES = 1 << 23
#: Words that a worker remembers (about 200 bytes each); beyond, it begins anew.
CACHE = 1_000_000
#: Two characters of white space side by side, as every Unicode-aware pattern may see it.
_RUNS = r"[\s\x0b\x1c-\x1f\x{85}\pZ][\s\x0b\x1c-\x1f\x{85}\pZ]"
#: Pieces that are encoded as one text.
_JOINED = 256
#: Before a word that has no blank before it, to remember it by; no piece of a text has a blank.
_BEGUN = "  "
#: Marks that make a token of their own behind a letter or digit.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters and digits that stay such in any normal form and lower case: marks behind them are no part of their word.
_CLOSED = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{391}-\x{3A1}\x{3A3}-\x{3A9}\x{3B1}-\x{3C9}\x{410}-\x{44F}]$"
_loaded: dict[tuple[str, bool], Encoder] = {}


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Words:
    """Ids of words met before: word -> number; ids of all numbers in one array."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def find(self, words: list[str]) -> np.ndarray:
        """Numbers; -1 for words that are not known."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words that are not known, each once."""
        a, b = len(self.number), len(self.number) + len(words)
        self.ids, self.starts, self.sizes = _grown(self.ids, self.used + len(ids)), _grown(self.starts, b), _grown(self.sizes, b)
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[a:b] = self.used + np.cumsum(sizes) - sizes
        self.sizes[a:b] = sizes
        self.used += len(ids)
        self.number.update(zip(words, range(a, b)))


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


class Encoder:
    """Ids of whole texts, equal to Tokenizer.encode(text, add_special_tokens=False).ids.

    Both supported kinds of tokenizer split a text at every single blank or line end between other characters, and
    before ASCII marks that end such a piece behind a letter or digit; so a piece is a word and its closing marks, which
    are encoded alone and remembered. keep_blank: the blank before a word is part of it (byte-level BPE), and texts with
    runs of white space are encoded whole; else all white space vanishes and ASCII case with it. Texts are split, and
    equal pieces found, by Arrow; Python code runs for each different word of a block, not for each word of a text.
    """

    def __init__(self, path: str, keep_blank: bool, cache: int = CACHE):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.keep_blank, self.cache = Tokenizer.from_file(path), keep_blank, cache
        self.words = Words()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Every word of letters has one token that begins (byte-level) or ends (word ends) a word.
        edge = (lambda t: t.startswith("Ġ")) if keep_blank else (lambda t: t.endswith("</w>"))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[k for t, k in vocabulary.items() if edge(t)]] = True

    @classmethod
    def get(cls, path: str, keep_blank: bool, cache: int = CACHE) -> Encoder:
        if (path, keep_blank) not in _loaded:
            _loaded[path, keep_blank] = cls(path, keep_blank, cache)
        return _loaded[path, keep_blank]

    def _plain(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(found, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _lettered(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As _plain, of words of letters alone, with a blank before each that is kept. Many are one text."""
        before, ids, sizes = " " if self.keep_blank else "", [], []
        groups = [found[k : k + _JOINED] for k in range(0, len(found), _JOINED)]
        for own, e in zip(groups, self.tokenizer.encode_batch_fast([before + " ".join(g) for g in groups], add_special_tokens=False)):
            got = np.array(e.ids, np.uint32)
            at = np.flatnonzero(self.edge[got])
            if len(at) == len(own):
                ids.append(got)
                sizes.append(np.diff(at, append=len(got)) if self.keep_blank else np.diff(at, prepend=-1))
            else:
                one, n = self._plain([before + w for w in own])
                ids.append(one)
                sizes.append(n)
        return np.concatenate(ids), np.concatenate(sizes)

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The number of each of different words, which is encoded if it was not met before."""
        at = self.words.find(words)
        new = np.flatnonzero(at < 0)
        if len(new):
            lacking = [words[k] for k in new.tolist()]
            letters = pc.match_substring_regex(pa.array(lacking, pa.large_string()), r"^\pL+$").to_numpy(zero_copy_only=False).astype(bool)
            own, first = [w for w, ok in zip(lacking, letters) if ok], len(self.words.number)
            if own:
                self.words.add(own, *self._lettered(own))
                at[new[letters]] = first + np.arange(len(own))
            own, first = [w for w, ok in zip(lacking, letters) if not ok], len(self.words.number)
            if own:
                text = [w[len(_BEGUN) :] if w.startswith(_BEGUN) else " " + w for w in own] if self.keep_blank else own
                self.words.add(own, *self._plain(text))
                at[new[~letters]] = first + np.arange(len(own))
        return at

    def _parts(self, pieces: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray, list[str]]:
        """Each piece as a word and the number of its closing marks, and all sorts of closing marks; the first is none."""
        word = pc.ascii_rtrim(pieces, characters=_MARKS)
        whole = pc.invert(pc.match_substring_regex(word, _CLOSED))
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(pieces, token))
        word = pc.if_else(whole, pieces, word)
        size, own = (pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (pieces, word))
        closed = np.flatnonzero(size > own)
        raw, offsets = np.frombuffer(pieces.buffers()[2] or b"", np.uint8), np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset :]
        cuts = np.concatenate([[0], np.cumsum((size - own)[closed])])
        marks = raw[ranges(offsets[closed] + own[closed], (size - own)[closed])]
        coded = pa.LargeStringArray.from_buffers(len(closed), pa.py_buffer(cuts), pa.py_buffer(marks)).dictionary_encode()
        tail = np.zeros(len(pieces), np.int64)
        tail[closed] = coded.indices.to_numpy() + 1
        return word, tail, ["", *coded.dictionary.to_pylist()]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block (UTF-8 bytes and offsets) one after another, and where each text's ids end."""
        n = len(offsets) - 1
        found = pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        if self.keep_blank:
            whole = pc.match_substring_regex(found, _RUNS).to_numpy(zero_copy_only=False).astype(bool)
            regular = pc.if_else(pa.array(whole), "", found) if whole.any() else found
            split = pc.split_pattern(pc.replace_substring(regular, "\n", " \n"), " ")
        else:
            split = pc.ascii_split_whitespace(pc.ascii_lower(found))
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        bounds = split.offsets.to_numpy().astype(np.int64)
        pieces = coded.dictionary
        if self.keep_blank:
            # The first piece of a text has no blank before it; a text that is encoded whole has one piece, put in below.
            begun = pieces.take(coded.indices.take(pa.array(bounds[:-1]))).dictionary_encode()
            at[bounds[:-1]] = len(pieces) + begun.indices.to_numpy()
            first = np.zeros(len(pieces) + len(begun.dictionary), bool)
            first[len(pieces) :] = True
            pieces = pa.concat_arrays([pieces, begun.dictionary])
        word, tail, marks = self._parts(pieces)
        if self.keep_blank:
            lined = pc.starts_with(word, "\n").to_numpy(zero_copy_only=False)
            word = pc.if_else(pa.array(lined), pc.utf8_slice_codeunits(word, 1), word)
            bare = pa.array(lined | first)
            word = pc.if_else(bare, pc.binary_join_element_wise(pa.scalar(_BEGUN, pa.large_string()), word, pa.scalar("", pa.large_string())), word)
        if len(self.words.number) > self.cache:
            self.words = Words()
        extra = [_BEGUN + m for m in [*marks, "\n"]] if self.keep_blank else marks
        once = word.dictionary_encode()  # pieces with other marks behind them have the same word
        number = self._numbers(once.dictionary.to_numpy(zero_copy_only=False).tolist()).take(once.indices.to_numpy())
        closing, table = self._numbers(extra), self.words
        parts = [number, closing[tail]]
        if self.keep_blank:
            parts.insert(0, np.where(lined, closing[-1], closing[0]))
        # The ids of a piece are those of its line end, its word and its closing marks.
        which = np.stack(parts, 1).ravel()
        sizes = table.sizes.take(which)
        ids = table.ids.take(ranges(table.starts.take(which), sizes))
        sizes = sizes.reshape(len(pieces), -1).sum(1)
        starts = np.cumsum(sizes) - sizes
        if self.keep_blank and whole.any():
            more, n_more = self._plain(found.filter(pa.array(whole)).to_pylist())
            at[bounds[:-1][whole]] = len(sizes) + np.arange(len(n_more))
            starts, sizes, ids = np.concatenate([starts, len(ids) + np.cumsum(n_more) - n_more]), np.concatenate([sizes, n_more]), np.concatenate([ids, more])
        times = sizes.take(at)
        ends = np.concatenate([[0], np.cumsum(times)])
        return ids.take(ranges(starts.take(at), times)), ends[bounds[1:]]

    def documents(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> list[np.ndarray]:
        """The ids of each text with the end id after them."""
        ids, ends = self.encode(data, offsets)
        ends = ends + np.arange(1, len(ends) + 1)
        out = np.empty(len(ids) + len(ends), np.uint32)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[inner], out[ends - 1] = ids, end_id
        at = [0, *ends.tolist()]
        return [out[a:b] for a, b in zip(at, at[1:])]
