"""Benchmark decontamination: a prefix-filtered set join of item windows with document shingles.

An item's windows are its runs of ``window`` successive words (one window if it has fewer).
A window is a set of ``shingle``-word shingles, and since it must be contained whole, its
prefix is one shingle: the one that is rarest in the corpus. A first pass over the documents
counts the items' shingles. The second joins document shingles with the windows' prefix
shingles, drops places where the window would leave the document (positional and length
bound) and verifies the rest word by word. Texts are looked at in slices of whole rows of about a megabyte.

Documents are never shuffled: items are the small side. They are joined in blocks of at most
``block_bytes`` of text, each of which is broadcast; a larger benchmark takes more blocks.

Defined cases: a NULL or wordless text has no words and no hits; an item without words has no
window; repeated items count once per ``item_id``; an item without id marks words but is not
listed; repeated documents are judged each for itself; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm import words as W

FILTER_BITS = 20
SLICE = 1 << 20
PAIRS_AT_ONCE = 1 << 20


@dataclass
class Windows:
    """The distinct windows of one block of items."""

    text: list[bytes] = field(default_factory=list)  # lower-cased words joined by spaces
    items: list[list[int]] = field(default_factory=list)
    hashes: list[np.ndarray] = field(default_factory=list)  # of the words
    shingle: int = 3

    def shingles(self, i: int) -> tuple[int, np.ndarray]:
        size = min(self.shingle, len(self.hashes[i]))
        return size, W.hash_runs(self.hashes[i], size)


def item_windows(items: list[tuple[int | None, str | None]], window: int, shingle: int) -> Windows:
    out, seen = Windows(shingle=shingle), {}
    offsets, data = W.raw(pa.array([t for _, t in items], pa.string()))
    starts, ends, first = W.spans(data, offsets, W.ALNUM)
    hashes, lowered = W.hash_words(data, starts, ends), W.LOWER[data]
    for k, (item, _) in enumerate(items):
        low, high = int(first[k]), int(first[k + 1])
        for at in range(low, max(high - window, low) + 1 if high > low else low):
            to = min(at + window, high)
            text = b" ".join(lowered[starts[w] : ends[w]].tobytes() for w in range(at, to))
            if text not in seen:
                seen[text] = len(out.text)
                out.text.append(text)
                out.items.append([])
                out.hashes.append(hashes[at:to])
            if item is not None and item not in out.items[seen[text]]:
                out.items[seen[text]].append(item)
    return out


@dataclass
class Tokens:
    """Sorted shingle hashes of one size with a bit table in front of them."""

    size: int
    hashes: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, size: int, hashes: np.ndarray) -> Tokens:
        hashes, table = np.unique(hashes), np.zeros(1 << FILTER_BITS, bool)
        table[hashes & np.uint64((1 << FILTER_BITS) - 1)] = True
        return cls(size, hashes, table)

    def find(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of words where one of the shingles starts inside one document, and which one it is."""
        runs = W.hash_runs(words, self.size)
        at = np.flatnonzero(self.table[runs & np.uint64((1 << FILTER_BITS) - 1)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.hashes, runs[at]), len(self.hashes) - 1)
        ends = first[np.searchsorted(first, at, "right")]
        good = (self.hashes[which] == runs[at]) & (at + self.size <= ends)
        return at[good], which[good]


def all_tokens(windows: Windows) -> list[Tokens]:
    by_size: dict[int, list[np.ndarray]] = {}
    for i in range(len(windows.text)):
        size, hashes = windows.shingles(i)
        by_size.setdefault(size, []).append(hashes)
    return [Tokens.of(size, np.concatenate(h)) for size, h in sorted(by_size.items())]


@dataclass
class Prefixes:
    """For each prefix shingle the windows it stands for and its place in them."""

    tokens: Tokens
    begin: np.ndarray
    window: np.ndarray
    place: np.ndarray


def prefixes(windows: Windows, tokens: list[Tokens], counts: dict[tuple[int, int], int]) -> list[Prefixes]:
    out = []
    for t in tokens:
        rows = []
        for i in range(len(windows.text)):
            size, hashes = windows.shingles(i)
            if size == t.size:
                ranks = np.searchsorted(t.hashes, hashes)
                place = min(range(len(ranks)), key=lambda k: (counts.get((size, int(ranks[k])), 0), ranks[k], k))
                rows.append((hashes[place], i, place))
        own = Tokens.of(t.size, np.array([r[0] for r in rows], np.uint64))
        which = np.searchsorted(own.hashes, np.array([r[0] for r in rows], np.uint64))
        order = np.argsort(which, kind="stable")
        begin = np.searchsorted(which[order], np.arange(len(own.hashes) + 1))
        out.append(Prefixes(own, begin, np.array([r[1] for r in rows])[order], np.array([r[2] for r in rows])[order]))
    return out


def _occurrences(index: Prefixes, words, first, lengths) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start word, window) of places that pass the bounds, a bounded number at a time."""
    at, which = index.tokens.find(words, first)
    if not len(at):
        return
    fan = np.diff(index.begin)[which]
    cuts = np.flatnonzero(np.diff(np.cumsum(fan) // PAIRS_AT_ONCE, prepend=0)) if len(fan) else []
    for a, f, w in zip(np.split(at, cuts), np.split(fan, cuts), np.split(which, cuts), strict=True):
        if not len(a):
            continue
        entry = np.repeat(index.begin[w] - np.cumsum(f) + f, f) + np.arange(f.sum())
        window = index.window[entry]
        start = np.repeat(a, f) - index.place[entry]
        doc = np.repeat(np.searchsorted(first, a, "right") - 1, f)
        fits = (start >= first[doc]) & (start + lengths[window] <= first[doc + 1])
        yield start[fits], window[fits]


class Matcher:
    """Finds and verifies windows in batches of documents; lives in one task."""

    def __init__(self, windows: Windows, indexes: list[Prefixes]):
        self.windows, self.indexes = windows, indexes
        self.lengths = np.array([len(h) for h in windows.hashes], np.int64)
        self.known: dict[bytes, bytes] = {}

    def _verified(self, data, starts, ends, words, at, window) -> np.ndarray:
        good = np.zeros(len(at), bool)
        for size in np.unique(self.lengths[window]):
            own = np.flatnonzero(self.lengths[window] == size)
            want = np.array([self.windows.hashes[w] for w in np.unique(window[own])], np.uint64)
            rank = np.searchsorted(np.unique(window[own]), window[own])
            same = np.ones(len(own), bool)
            for k in range(size):
                same &= words[at[own] + k] == want[rank, k]
            good[own[same]] = True
        for i in np.flatnonzero(good):
            span = data[starts[at[i]] : ends[at[i] + self.lengths[window[i]] - 1]].tobytes()
            if (text := self.known.get(span)) is None:
                run = range(at[i], at[i] + self.lengths[window[i]])
                text = b" ".join(W.LOWER[data[starts[w] : ends[w]]].tobytes() for w in run)
                if len(self.known) < 100_000:
                    self.known[span] = text
            good[i] = text == self.windows.text[window[i]]
        return good

    def hits(self, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[list[int]]]:
        """Per document: number of words, runs of hit words as (start, end) rows, ids of items with an occurrence."""
        offsets, data = W.raw(column)
        starts, ends, first = W.spans(data, offsets, W.ALNUM)
        words = W.hash_words(data, starts, ends)
        change = np.zeros(len(words) + 1, np.int64)
        found: dict[int, set[int]] = {}
        for index in self.indexes:
            for at, window in _occurrences(index, words, first, self.lengths):
                good = self._verified(data, starts, ends, words, at, window)
                at, window = at[good], window[good]
                np.add.at(change, at, 1)
                np.add.at(change, at + self.lengths[window], -1)
                pairs = np.unique(np.stack([np.searchsorted(first, at, "right") - 1, window]), axis=1)
                for doc, w in pairs.T:
                    found.setdefault(int(doc), set()).update(self.windows.items[w])
        hit = np.zeros(len(words) + 2, bool)
        hit[1:-1] = np.cumsum(change[:-1]) > 0
        runs = []
        for k in range(len(first) - 1):
            low, high = first[k], first[k + 1]
            if high == low or not hit[low + 1 : high + 1].any():
                runs.append(np.zeros((0, 2), np.int64))
                continue
            own = np.concatenate([[False], hit[low + 1 : high + 1], [False]])
            runs.append(np.flatnonzero(own[1:] != own[:-1]).reshape(-1, 2))
        return np.diff(first), runs, [sorted(found.get(k, ())) for k in range(len(first) - 1)]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items in blocks of about ``block_bytes``, fetched one block at a time."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = benchmark.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) if n > 1 else benchmark
        yield [(r.item_id, r.text) for r in part.select("item_id", "text").distinct().collect()]


def _counted(docs: DataFrame, tokens: list[Tokens]) -> dict[tuple[int, int], int]:
    shared = docs.sparkSession.sparkContext.broadcast(tokens)

    def count(batches):
        sums = [np.zeros(len(t.hashes), np.int64) for t in shared.value]
        for batch in batches:
            for part in W.slices(batch, limit=SLICE):
                offsets, data = W.raw(part.column("text"))
                starts, ends, first = W.spans(data, offsets, W.ALNUM)
                words = W.hash_words(data, starts, ends)
                for t, s in zip(shared.value, sums, strict=True):
                    s += np.bincount(t.find(words, first)[1], minlength=len(s))
        for t, s in zip(shared.value, sums, strict=True):
            seen = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), t.size)), pa.array(seen), pa.array(s[seen])], ["size", "token", "n"]
            )

    rows = docs.select("text").mapInArrow(count, "size long, token long, n long")
    # at most one row per shingle of the block
    return {(r.size, r.token): r.n for r in rows.groupBy("size", "token").agg(F.sum("n").alias("n")).collect()}


RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = [T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(RUN)), T.StructField("items", T.ArrayType(T.LongType()))]


def find_benchmark_windows(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, block_bytes: int = 16 << 20
) -> DataFrame:
    """``doc_id, text, n_words, hits, items``: hit runs of words as half-open ranges of word numbers, and the items found.

    ``docs`` holds ``doc_id, text``, ``benchmark`` holds ``item_id, text``; ``doc_id`` may be of any type, also a struct.
    """
    sc = docs.sparkSession.sparkContext
    docs = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], docs.schema["text"], *FOUND])
    out = None
    for items in _blocks(benchmark, block_bytes):
        windows = item_windows(items, window, shingle)
        tokens = all_tokens(windows)
        index = sc.broadcast((windows, prefixes(windows, tokens, _counted(docs, tokens) if tokens else {})))
        out = (docs if out is None else out).mapInArrow(_marker(index, out is None), schema)
    return out


def _marker(index, fresh: bool):
    def mark(batches):
        matcher = Matcher(*index.value)
        for batch in batches:
            for part in W.slices(batch, limit=SLICE):
                n_words, runs, items = matcher.hits(part.column("text"))
                if not fresh:
                    runs = [_union(a, b) for a, b in zip(runs, part.column("hits").to_pylist(), strict=True)]
                    items = [sorted({*a, *b}) for a, b in zip(items, part.column("items").to_pylist(), strict=True)]
                flat = np.concatenate(runs) if runs else np.zeros((0, 2), np.int64)
                pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
                ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.array(n_words), pa.ListArray.from_arrays(ends, pairs),
                     pa.array(items, pa.list_(pa.int64()))],
                    ["doc_id", "text", "n_words", "hits", "items"],
                )

    return mark


def _union(runs: np.ndarray, more: list[dict]) -> np.ndarray:
    out: list[list[int]] = []
    for low, high in sorted([*map(tuple, runs.tolist()), *((r["start"], r["end"]) for r in more)]):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return np.array(out, np.int64).reshape(-1, 2)


def contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per document: how many words benchmark windows cover, and a digest of the items."""
    found = find_benchmark_windows(docs, benchmark, **how)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents that no benchmark window occurs in, with all their columns."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc_id"), docs["text"].alias("text"))
    return find_benchmark_windows(packed, benchmark, **how).where(F.size("hits") == 0).select("doc_id.*")


WINDOW_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
i AS (SELECT item_id, {words} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len(v) AS size, array_to_string(v, ' ') AS body FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - {window} + 1, 1) + 1), lambda k: w[k:k + {window} - 1])) AS v FROM i WHERE len(w) > 0
  )
),
places AS (
  SELECT r, size, unnest(range(1, len(w) - size + 2)) AS k, w FROM d, (SELECT DISTINCT size FROM windows) sizes WHERE len(w) >= size
),
met AS (SELECT p.r, p.k, p.size, o.item_id FROM (SELECT r, k, size, array_to_string(w[k:k + size - 1], ' ') AS body FROM places) p JOIN windows o USING (size, body)),
hit AS (SELECT r, COUNT(DISTINCT n) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS n FROM (SELECT DISTINCT r, k, size FROM met)) GROUP BY r),
found AS (
  SELECT r, COUNT(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN found USING (r)
"""
_WORDS_SQL = """regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""


def window_sql(window: int) -> str:
    """The digest columns of ``contamination`` from ``documents`` and ``benchmark``; every window of a text is joined with every item's."""
    return WINDOW_SQL.format(words=_WORDS_SQL, window=window)
