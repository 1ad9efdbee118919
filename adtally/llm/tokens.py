"""Token ids of whole Arrow batches with a public ``word_bpe`` tokenizer and a memory of pre-tokens.

The tokenizer lower-cases, drops white space, splits into runs of letters, single digits, runs
of signs and the usual contractions, and encodes each such pre-token on its own. Pre-tokens
are found in numpy; each distinct one is encoded once by the tokenizer library and remembered
under a 64-bit hash. Texts with characters outside the plain range below, or with the text of
a special token, go to the tokenizer whole, so every text gets the ids it would get there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from adtally.llm import words as W

REMEMBERED = 1_200_000

SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[33:127] = SIGN
_KIND[[9, 10, 13, 32]] = SPACE
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
# second bytes of two-byte characters that stay one sign: inverted marks and angle quotes
_C2_SIGNS = np.array([0xA1, 0xAB, 0xBB, 0xBF], np.uint8)


@dataclass
class PreTokens:
    """Pre-tokens of a batch: byte ranges in ``data`` (lower-cased), and for each text the number before it."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    odd: np.ndarray  # texts that are not plain; they have no pre-tokens here


def pre_tokens(offsets: np.ndarray, data: np.ndarray) -> PreTokens:
    kind, lowered = _KIND[data], W.LOWER[data]
    bad = []
    lead = np.flatnonzero(data >= 0xC0)
    follow = lead + 1  # a two-byte character's second byte; the input is valid UTF-8
    first, second = data[lead], data[np.minimum(follow, len(data) - 1)] if len(data) else data[lead]
    times = (first == 0xC3) & ((second == 0x97) | (second == 0xB7))
    letter = (first == 0xC3) & ~times | (first == 0xC4) & (second <= 0xAF)
    sign = times | (first == 0xC2) & np.isin(second, _C2_SIGNS)
    for mask, value in ((letter, LETTER), (sign, SIGN)):
        kind[lead[mask]] = kind[follow[mask]] = value
    up = follow[(first == 0xC3) & (second < 0x9F) & ~times]
    lowered[up] += 0x20
    up = follow[(first == 0xC4) & (second <= 0xAF) & (second % 2 == 0)]
    lowered[up] += 1
    bad.append(np.flatnonzero(kind == OTHER))
    bad.append(np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)))  # may be a special token
    odd = np.unique(np.searchsorted(offsets, np.concatenate(bad), "right") - 1)
    for k in odd:
        kind[offsets[k] : offsets[k + 1]] = SPACE
    n = len(data)
    opens = np.zeros(n + 1, bool)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    token = kind != SPACE
    opens[:n] = token
    opens[1:n] &= (kind[1:] != kind[:-1]) | border[1:n]
    # continuation bytes share their lead's kind, so only ASCII digits open a pre-token each
    opens[:n] |= kind == DIGIT
    _contractions(lowered, kind, opens, border)
    closes = token & (opens[1:] | border[1:] | np.append(~token[1:], True))
    starts, ends = np.flatnonzero(opens[:n]), np.flatnonzero(closes) + 1
    return PreTokens(lowered, starts, ends, np.searchsorted(starts, offsets), odd)


def _contractions(data, kind, opens, border) -> None:
    """A lone apostrophe before s, t, m, d, re, ve or ll takes those letters with it."""
    n = len(data)
    at = np.flatnonzero((data == 0x27) & opens[:n])
    at = at[at + 1 < n]
    at = at[(kind[at + 1] == LETTER) & ~border[at + 1]]
    one = data[at + 1]
    two = np.where(at + 2 < n, data[np.minimum(at + 2, n - 1)], 0)
    two = np.where(border[np.minimum(at + 2, n)], 0, two)
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for mask, size in ((np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1), (pair, 2)):
        own = at[mask]
        opens[own + 1] = False
        rest = own + 1 + size
        rest = rest[rest < n]
        opens[rest[(kind[rest] == LETTER) & ~border[rest]]] = True


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others as letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class _Memory:
    """Hash -> ids in an open-addressed table that is kept at most half full."""

    def __init__(self):
        self.own, self.begin, self.count = np.zeros(1, np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self._table(16)

    def _table(self, bits: int) -> None:
        self.bits, self.keys, self.entry = bits, np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self._place(self.own[1:], np.arange(1, len(self.own), dtype=np.int32))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """The slot that holds each key, or the free one where its search ends. 0 marks a free slot."""
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[at]
        open_ = np.flatnonzero((held != keys) & (held != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[open_]]
            open_ = open_[(held != keys[open_]) & (held != 0)]
        return at

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        begin = len(self.flat) + np.cumsum(count) - count
        number = len(self.count) + np.arange(len(ids), dtype=np.int32)
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))])
        self.begin, self.count = np.concatenate([self.begin, begin]), np.concatenate([self.count, count])
        self.own = np.concatenate([self.own, keys])
        if 2 * len(self.own) > 1 << self.bits:
            self._table((4 * len(self.own)).bit_length())
        else:
            self._place(keys, number)

    def _place(self, keys: np.ndarray, number: np.ndarray) -> None:
        while len(keys):
            at = self.slot(keys)
            _, pick = np.unique(at, return_index=True)  # of keys that want one slot, one gets it
            self.keys[at[pick]], self.entry[at[pick]] = keys[pick], number[pick]
            left = np.ones(len(keys), bool)
            left[pick] = False
            keys, number = keys[left], number[left]


class WordTokenizer:
    """One per Python worker; tasks that follow in that worker find its memory filled."""

    _open: dict[str, WordTokenizer] = {}

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory, self.letters = _Memory(), _byte_letters()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _entries(self, found: PreTokens) -> np.ndarray:
        """Index into the memory for each pre-token, after encoding those it lacks."""
        hashes = np.maximum(W.hash_words(found.data, found.starts, found.ends), np.uint64(1))
        if len(self.memory.count) > REMEMBERED:
            self.memory = _Memory()
        slot = self.memory.slot(hashes)
        lost = np.flatnonzero(self.memory.keys[slot] == 0)
        if len(lost):
            keys, sample = np.unique(hashes[lost], return_index=True)
            self._learn(found, keys, lost[sample])
            slot = self.memory.slot(hashes)
        return self.memory.entry[slot]

    def _learn(self, found: PreTokens, keys: np.ndarray, sample: np.ndarray) -> None:
        encode, ids, data, letters = self.tokenizer.model.tokenize, [], found.data.tobytes().decode("latin-1"), self.letters
        for a, b in zip(found.starts[sample].tolist(), found.ends[sample].tolist(), strict=True):
            word = data[a:b]
            ids.append([t.id for t in encode(word if word.isascii() else word.translate(letters))])
        self.memory.add(keys, ids)

    def ids(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers."""
        found = pre_tokens(*W.raw(column))
        entry = self._entries(found)
        begin, count = self.memory.begin[entry], self.memory.count[entry]
        ends = np.concatenate([[0], np.cumsum(count)])
        flat = self.memory.flat[np.repeat(begin - ends[:-1], count) + np.arange(ends[-1])]
        cuts = ends[found.first]
        out = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for k in found.odd:
            out[k] = self.whole(column[int(k)].as_py())
        return out

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        found = pre_tokens(*W.raw(column))
        ends = np.concatenate([[0], np.cumsum(self.memory_counts(found))])
        out = np.diff(ends[found.first])
        for k in found.odd:
            out[k] = len(self.whole(column[int(k)].as_py()))
        return out

    def memory_counts(self, found: PreTokens) -> np.ndarray:
        entry = self._entries(found)
        return self.memory.count[entry]
