"""Words, word hashes and shingle hashes of whole Arrow batches, in numpy.

A batch is looked at as one run of UTF-8 bytes; document borders end words. Nothing here
looks across documents and nothing is cut: a batch is only walked in slices of whole rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
LONG_WORD = 32

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# anything between ASCII white space
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

# ASCII digits and letters and all non-ASCII characters
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, ends, data = column.buffers()
    if len(column) == 0 or ends is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], body[offsets[0] : offsets[-1]]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows of about ``limit`` bytes of text, at least one row each."""
    if batch.num_rows == 0:
        return
    offsets, _ = raw(batch.column(text))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def windows(data: np.ndarray, inside: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """One text in pieces of about ``limit`` bytes that end at a byte which is not ``inside`` a word; a longer word is one piece."""
    low = 0
    while low < len(data):
        high = min(low + limit, len(data))
        if high < len(data):
            gaps = np.flatnonzero(~inside[data[low:high]])
            while not len(gaps) and high < len(data):
                high = min(2 * high - low, len(data))
                gaps = np.flatnonzero(~inside[data[low:high]])
            if high < len(data):
                high = low + int(gaps[-1]) + 1
        yield data[low:high]
        low = high


def spans(data: np.ndarray, offsets: np.ndarray, wordlike: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each document the number of words before it (one more entry at the end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = wordlike[data]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    opens = inside[1:] & ~inside[:-1]
    opens[borders] = inside[borders + 1]
    closes = ~inside[1:] & inside[:-1]
    closes[borders] = inside[borders]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(27))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's lower-cased bytes (ASCII letters only)."""
    lowered = np.zeros(len(data) + 8, np.uint8)
    lowered[:-8] = LOWER[data]
    eight = np.ndarray((len(data) + 1,), "<u8", lowered, strides=(1,))
    length = ends - starts
    h = length.astype(np.uint64) * _MUL
    at = None
    for k in range(0, LONG_WORD, 8):
        at = np.arange(len(starts)) if at is None else at[length[at] > k]
        if not len(at):
            break
        left = np.minimum(length[at] - k, 8).astype(np.uint64)
        part = eight[starts[at] + k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))
        h[at] = mixed((h[at] ^ part) * _MUL)
    for i in np.flatnonzero(length > LONG_WORD):
        digest = hashlib.blake2b(lowered[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(digest, "<u8")[0]
    return h


def hash_runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` successive entries, one per starting entry (document borders are the caller's)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mixed((h ^ words[k : k + n]) * _MUL)
    return h


def owners(first: np.ndarray) -> np.ndarray:
    """The document index of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
