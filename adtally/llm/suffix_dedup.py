"""Repeated byte strings across documents by external induced suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
smaller id. All strings are judged on the input.

Sorting every suffix would move many times the input, so only sampled suffixes are sorted and the
others induced from them:

1. Sample. Of each string of ``length`` bytes the ``GRAM``-byte piece with the least hash is an
   anchor; ties are all taken. Equal strings have equal anchors at equal places, so strings meet by
   their anchors. Anchor hashes are dealt into shards by value, and those found in one document only
   are done with. Hashes that a task meets in several documents are settled there and sent on once.
2. Sort. For anchors in several documents the bytes around them (at most ``length`` to the right,
   ``length - GRAM`` to the left) go to the anchor's shard, equal ones of a task once. There suffixes are
   sorted by induction, from the last byte leftwards: the suffixes at one place, in order, are pushed
   with their preceding byte into a priority queue and come out as the order one byte further left.
   The common-prefix value of neighbours travels along: that of two suffixes with the same preceding
   byte is one more than the least value between them. After the anchor itself every further step
   gives the order of the strings that start that much before it, where values of ``length`` mark
   equal strings. The queue has one first-in-first-out run per byte (ranks arrive in order) and
   keeps its runs in a file beyond a memory budget; so do the columns of bytes.
3. Remove. Intervals return to their documents, which are cut and digested.

Texts travel compressed, once for step 2 and once for step 3; steps meet documents by a hash group
of the id, blobs first, then documents as a stream.

Defined cases: a NULL text is empty; rows of one id never remove each other's bytes, each row gets its own
result; a NULL id counts as larger than any other; texts shorter than ``length`` stay whole.
"""

from __future__ import annotations

import hashlib
import itertools
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm import words as W
from adtally.llm.common import Stages, tasks_for

GRAM = 16
PUSH_ITEMS = 1 << 18
QUEUE_BYTES = 64 << 20
SEND_ITEMS = 100_000
NO_ID = np.iinfo(np.int64).max
ROWS = "grp int, turn int, doc_id long, copy long, body binary"


# --- packing -------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    press = zstandard.ZstdCompressor(level=1)
    parts = [press.compress(np.ascontiguousarray(a).tobytes()) for a in arrays]
    return np.array([len(parts), *map(len, parts)], "<i4").tobytes() + b"".join(parts)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    head = np.frombuffer(blob, "<i4", len(kinds) + 1)
    ends = 4 * len(head) + np.cumsum(head) - head[0]
    press = zstandard.ZstdDecompressor()
    return [np.frombuffer(press.decompress(blob[b - n : b]), kind) for n, b, kind in zip(head[1:], ends[1:], kinds, strict=True)]


def copy_of(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def group_of(doc_id: np.ndarray, groups: int) -> np.ndarray:
    return (W.mixed(doc_id.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(groups)).astype(np.int64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


# --- 1. anchors ----------------------------------------------------------------------------


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` entries."""
    size = 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all strings of ``length`` bytes that lie within one text."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = data
    eight = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    a, b = eight[: n - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15), eight[8 : n - GRAM + 9]
    h = np.maximum(W.mixed((W.mixed(a) ^ b) * np.uint64(0xD6E8FEB86659FD93)), np.uint64(1))
    width = length - GRAM + 1
    least = _sliding(h, width, np.minimum)
    starts = np.arange(len(least))
    least[np.repeat(offsets[1:], np.diff(offsets))[: len(least)] - starts < length] = 0
    edge = np.zeros(width - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    at = np.flatnonzero(most == h)
    return at, h[at]


def _find(length: int, shards: int, groups: int):
    """Anchor hashes packed by shard (turn 0); positions settled in the task packed by document group (turn 1)."""

    def run(batches):
        for batch in (part for whole in batches for part in W.slices(whole, limit=2 * W.SLICE_BYTES)):
            offsets, data = W.raw(batch.column("text"))
            ids = _ids(batch.column("doc_id"))
            copies = np.array([copy_of(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)
            at, h = anchors(data, offsets, length)
            doc = np.searchsorted(offsets, at, "right") - 1
            place = at - offsets[doc]
            order = np.lexsort((ids[doc], h))
            h, doc, place = h[order], doc[order], place[order]
            shared, first = _several(h, ids[doc])
            out = _by_group(ids, copies, doc[shared], place[shared], groups)
            use = ~shared | first
            h, doc, place = h[use], doc[use], place[use]
            settled = shared[use]
            shard = (h >> np.uint64(40)) % np.uint64(shards)
            order = np.lexsort((place, doc, shard))
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(edges)):
                own = order[edges[s] : edges[s + 1]]
                used, local = np.unique(doc[own], return_inverse=True)
                blob = pack(
                    ids[used], copies[used], np.diff(local, prepend=0).astype(np.int32), np.diff(place[own], prepend=0).astype(np.int32),
                    (h[own] & np.uint64(0xFFFFFFFF)).astype(np.uint32), (h[own] >> np.uint64(32)).astype(np.uint8), settled[own],
                )
                out.append((int(s), 0, blob))
            yield _blobs(out)

    return run


_BLOB = "grp int, turn int, body binary"


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["grp", "turn", "body"])


def _several(key: np.ndarray, doc_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: is the key in several documents, and is this its first row?"""
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    begin = np.flatnonzero(first)
    if not len(begin):
        return first, first
    several = np.minimum.reduceat(doc_id, begin) != np.maximum.reduceat(doc_id, begin)
    return np.repeat(several, np.diff(np.append(begin, len(key)))), first


def _by_group(ids, copies, doc, *columns_and_groups) -> list[tuple[int, int, bytes]]:
    """Rows (group, 1, packed ids, copies, local document, columns) by document group."""
    *columns, groups = columns_and_groups
    group = group_of(ids[doc], groups)
    order = np.lexsort((columns[0], doc, group))
    edges = np.searchsorted(group[order], np.arange(groups + 1))
    out = []
    for g in np.flatnonzero(np.diff(edges)):
        own = order[edges[g] : edges[g + 1]]
        used, local = np.unique(doc[own], return_inverse=True)
        out.append((int(g), 1, pack(ids[used], copies[used], np.diff(local, prepend=0).astype(np.int32), *(np.diff(c[own], prepend=0).astype(np.int32) for c in columns))))
    return out


def _settle(groups: int):
    """Shards of hashes in, positions of anchors in several documents out, by document group."""

    def run(batches):
        for _, blobs in _runs(batches):
            ids, copies, docs, places, hashes, done, base = [], [], [], [], [], [], 0
            for blob in blobs:
                i, c, d, p, low, high, s = unpack(blob, np.int64, np.int64, np.int32, np.int32, np.uint32, np.uint8, bool)
                ids.append(i)
                copies.append(c)
                docs.append(np.cumsum(d, dtype=np.int64) + base)
                places.append(np.cumsum(p, dtype=np.int64))
                hashes.append(low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)))
                done.append(s)
                base += len(i)
            ids, copies, doc, place, h, settled = map(np.concatenate, (ids, copies, docs, places, hashes, done))
            order = np.argsort(h, kind="stable")
            shared, _ = _several(h[order], ids[doc[order]])
            use = order[shared]
            use = use[~settled[use]]
            yield _blobs(_by_group(ids, copies, doc[use], place[use], groups))

    def both(batches):
        passed = []

        def shards():
            for batch in batches:
                turn = batch.column("turn").to_numpy()
                if (turn == 1).any():
                    passed.append(batch.filter(pa.array(turn == 1)))
                if (turn == 0).any():
                    yield batch.filter(pa.array(turn == 0))

        for out in run(shards()):
            yield from passed
            passed.clear()
            yield out
        yield from passed

    return both


def _runs(batches) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(group, its blobs) of rows sorted by group; the blobs are read as they come."""
    rows = (r for b in batches for r in zip(b.column("grp").to_pylist(), b.column("body").to_pylist(), strict=True))
    for grp, own in itertools.groupby(rows, key=lambda r: r[0]):
        yield grp, (body for _, body in own)


# --- 2. induced sorting --------------------------------------------------------------------


def range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low..high]``, both ends included."""
    table, size = [values], 1
    while 2 * size <= len(values):
        table.append(np.minimum(table[-1][:-size], table[-1][size:]))
        size *= 2
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), values.dtype)
    for k in np.unique(level):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[k][low[own]], table[k][high[own] - (1 << int(k)) + 1])
    return out


class Spill:
    """Arrays that move to a temporary file when they are large; the file goes with the object."""

    def __init__(self, budget: int = QUEUE_BYTES):
        self.left, self.file, self.end = budget, None, 0

    def keep(self, array: np.ndarray):
        if array.nbytes <= self.left:
            self.left -= array.nbytes
            return array
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        self.file.write(np.ascontiguousarray(array).data)
        place, self.end = (self.end, array.shape, array.dtype), self.end + array.nbytes
        return place

    def load(self, kept) -> np.ndarray:
        if isinstance(kept, np.ndarray):
            return kept
        at, shape, kind = kept
        self.file.seek(at)
        return np.frombuffer(self.file.read(int(np.prod(shape)) * np.dtype(kind).itemsize), kind).reshape(shape)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class ByteQueue:
    """Priority queue of suffixes by (preceding byte, rank) that carries items and common-prefix values.

    Suffixes are pushed in rank order, so each byte's run is in order and popping runs byte by byte
    gives the next order. ``cap`` bounds the values.
    """

    def __init__(self, cap: int):
        self.cap, self.spill = cap, Spill()
        self.runs: list[list[tuple]] = [[] for _ in range(256)]
        self.least = np.full(256, 255, np.uint8)  # common prefix with the last item of each byte, so far
        self.seen = np.zeros(256, bool)

    def push(self, byte: np.ndarray, item: np.ndarray, common: np.ndarray) -> None:
        order = np.argsort(byte, kind="stable")
        sorted_byte = byte[order]
        first = np.ones(len(order), bool)
        first[1:] = sorted_byte[1:] != sorted_byte[:-1]
        low = np.zeros(len(order), np.int64)
        low[1:] = order[:-1] + 1
        low[first] = 0
        gap = range_min(common, low, order)
        heads = np.flatnonzero(first)
        gap[heads] = np.minimum(gap[heads], self.least[sorted_byte[heads]])
        value = np.minimum(gap, self.cap - 1) + np.uint8(1)
        value[heads[~self.seen[sorted_byte[heads]]]] = 0
        tails = np.append(heads[1:], len(order)) - 1
        self.least = np.minimum(self.least, common.min())
        after = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(255))
        self.least[sorted_byte[tails]] = after[order[tails] + 1]
        self.seen[sorted_byte[heads]] = True
        item = item[order]
        for a, b in zip(heads, tails + 1, strict=True):
            self.runs[sorted_byte[a]].append((self.spill.keep(item[a:b]), self.spill.keep(value[a:b])))

    def pop(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(items, common-prefix values) in order, in pieces of about ``PUSH_ITEMS``."""
        items, values, n = [], [], 0
        for runs in self.runs:
            for item, value in runs:
                items.append(self.spill.load(item))
                values.append(self.spill.load(value))
                n += len(items[-1])
                if n >= PUSH_ITEMS:
                    yield np.concatenate(items), np.concatenate(values)
                    items, values, n = [], [], 0
        if n:
            yield np.concatenate(items), np.concatenate(values)
        self.spill.close()


def induced(columns: list, load, n: int, cap: int) -> Iterator[tuple[int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(column, its order as pieces) from the last column to the first. The pieces must be read before going on."""
    pieces: Iterator = iter([(np.arange(n), np.zeros(n, np.uint8))])
    for t in range(len(columns) - 1, -1, -1):
        queue, byte = ByteQueue(cap), load(columns[t])
        for items, common in pieces:
            for low in range(0, len(items), PUSH_ITEMS):
                part = items[low : low + PUSH_ITEMS]
                queue.push(byte[part], part, common[low : low + PUSH_ITEMS])
        kept = list(queue.pop()) if n <= PUSH_ITEMS else queue.pop()
        if n <= PUSH_ITEMS:
            yield t, iter(kept)
            pieces = iter(kept)
        else:
            # read twice: once by the caller, once for the next step
            store = Spill()
            again = [(store.keep(i), store.keep(c)) for i, c in kept]
            yield t, ((store.load(i), store.load(c)) for i, c in again)
            pieces = ((store.load(i), store.load(c)) for i, c in again)


def least_documents(pieces, doc: np.ndarray, cap: int) -> np.ndarray:
    """For each item the least document among those whose strings are equal to its own."""
    out = np.empty(len(doc), np.int64)
    open_items, open_least = [], NO_ID
    for items, common in pieces:
        first = common < cap
        first[0] |= not open_items
        begin = np.flatnonzero(first)
        head = begin[0] if len(begin) else len(items)
        if head:  # goes on with the last run of the piece before
            open_items.append(items[:head])
            open_least = min(open_least, int(doc[items[:head]].min()))
        if not len(begin):
            continue
        if open_items:
            out[np.concatenate(open_items)] = open_least
        least = np.minimum.reduceat(doc[items], begin)
        sizes = np.diff(np.append(begin, len(items)))
        out[items[begin[0] :]] = np.repeat(least, sizes)
        open_items, open_least = [items[begin[-1] :]], int(least[-1])
    if open_items:
        out[np.concatenate(open_items)] = open_least
    return out


def _contexts(length: int, shards: int):
    """Blobs of positions, then documents, in; the bytes around those positions out, by shard of their anchor."""
    left, width = length - GRAM, 2 * length - GRAM

    def flushed(rows):
        ids, copies, shift = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 4))
        doc = np.repeat(np.arange(len(rows)), [len(r[3]) for r in rows])
        place = np.concatenate([r[3] for r in rows])
        # zeros around each text: bytes of other texts never get in
        data = np.frombuffer(b"".join(x for r in rows for x in (b"\0" * left, r[2], b"\0" * length)), np.uint8)
        size = np.array([len(r[2]) for r in rows], np.int64)
        begin = np.cumsum(size + left + length) - size - left - length
        lefts, rights = np.minimum(place, left), np.minimum(size[doc] - place, length)
        body = np.lib.stride_tricks.sliding_window_view(data, width)[begin[doc] + place]
        pick, back = _distinct(body, lefts * (length + 1) + rights)
        gram = np.ascontiguousarray(body[pick, left : left + GRAM]).view("<u8")
        shard = W.mixed(W.mixed(gram[:, 0] * np.uint64(0xD6E8FEB86659FD93)) ^ gram[:, 1]) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        context = rank[back]
        by_context = np.lexsort((doc, context))
        cuts = np.searchsorted(context[by_context], edges)
        out = []
        for s in np.flatnonzero(np.diff(edges)):
            own, uses = pick[order[edges[s] : edges[s + 1]]], by_context[cuts[s] : cuts[s + 1]]
            used, local = np.unique(doc[uses], return_inverse=True)
            out.append((int(s), 0, pack(
                ids[used], copies[used], body[own], lefts[own].astype(np.uint8), rights[own].astype(np.uint8),
                np.diff(context[uses] - edges[s], prepend=0).astype(np.int32), local.astype(np.int32), (place + shift[doc])[uses].astype(np.int32),
            )))
        return _blobs(out)

    def run(batches):
        found, rows, n = {}, [], 0
        for doc_id, copy, body in _documents(batches, found, 1):
            places = found.get((doc_id, copy))
            if places is None:
                continue
            places = np.unique(np.concatenate([p[0] for p in places]))
            text = zstandard.ZstdDecompressor().decompress(body)
            for low in range(0, len(places), SEND_ITEMS):
                part = places[low : low + SEND_ITEMS]
                a, b = max(0, int(part[0]) - left), int(part[-1]) + length
                rows.append((doc_id, copy, text[a:b], part - a, a))
                n += len(part)
                if n >= SEND_ITEMS:
                    yield flushed(rows)
                    rows, n = [], 0
        if rows:
            yield flushed(rows)

    return run


def _distinct(body: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct one, for each row its number among them)"""
    eight = np.zeros((len(body), -(-body.shape[1] // 8) * 8), np.uint8)
    eight[:, : body.shape[1]] = body
    key = sizes.astype(np.uint64)
    for word in eight.view("<u8").T:
        key = W.mixed((key ^ word) * np.uint64(0x9E3779B97F4A7C15))
    _, pick, back = np.unique(key, return_index=True, return_inverse=True)
    if (body[pick[back]] != body).any() or (sizes[pick[back]] != sizes).any():  # two share a hash
        _, pick, back = np.unique(np.column_stack([sizes, body]), axis=0, return_index=True, return_inverse=True)
    return pick, back.ravel()


def _intervals(length: int, groups: int):
    """Shards of contexts in, byte intervals to remove out, by document group."""
    left, width = length - GRAM, 2 * length - GRAM

    def run(batches):
        for _, blobs in _runs(batches):
            store = Spill()
            columns, n, base = [[] for _ in range(width)], 0, 0
            parts = []
            for blob in blobs:
                ids, copies, body, lefts, rights, context, doc, place = unpack(
                    blob, np.int64, np.int64, np.uint8, np.uint8, np.uint8, np.int32, np.int32, np.int32
                )
                for t, column in enumerate(body.reshape(-1, width).T):
                    columns[t].append(store.keep(np.ascontiguousarray(column)))
                parts.append((ids, copies, lefts, rights, np.cumsum(context, dtype=np.int64) + n, doc.astype(np.int64) + base, place.astype(np.int64)))
                n, base = n + len(lefts), base + len(ids)
            ids, copies, lefts, rights, context, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            owner = ids[doc]
            least = np.full(n, NO_ID, np.int64)
            np.minimum.at(least, context, owner)
            low, high = np.full(len(doc), -1, np.int64), np.full(len(doc), -1, np.int64)
            for t, pieces in induced(columns, lambda c: np.concatenate([store.load(x) for x in c]), n, length):
                before = left - t
                if before < 0:
                    continue
                within = (lefts >= before) & (rights.astype(np.int64) + before >= length)
                first = least_documents(pieces, np.where(within, least, NO_ID), length)
                hit = within[context] & (first[context] < owner)
                low[hit] = place[hit] - before
                high[hit & (high < 0)] = place[hit & (high < 0)] - before + length
            store.close()
            own = np.flatnonzero(high >= 0)
            yield _blobs(_by_group(ids, copies, doc[own], low[own], high[own], groups))

    return run


# --- 3. removal ----------------------------------------------------------------------------


def _removed(batches):
    found: dict = {}
    rows = []
    for doc_id, copy, body in _documents(batches, found, 2):
        text = zstandard.ZstdDecompressor().decompress(body)
        spans = _union(found.get((doc_id, copy), ()))
        at, kept = 0, []
        for low, high in spans:
            kept.append(text[at:low])
            at = high
        kept.append(text[at:])
        rows.append((None if doc_id == NO_ID else doc_id, len(text), [{"start": a, "end": b} for a, b in spans], b"".join(kept)))
        if sum(r[1] for r in rows[-64:]) > W.SLICE_BYTES or len(rows) >= 1024:
            yield _result(rows)
            rows = []
    yield _result(rows)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _result(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), _SPANS, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["doc_id", "n_bytes", "spans", "kept"])


def _union(intervals) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the intervals cover."""
    if not intervals:
        return []
    low, high = (np.concatenate([i[k] for i in intervals]) for k in (0, 1))
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    begin = np.flatnonzero(np.concatenate([[True], low[1:] > reach[:-1]]))
    return list(zip(low[begin].tolist(), reach[np.append(begin[1:], len(low)) - 1].tolist(), strict=True))


def _texts(groups: int):
    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in W.slices(whole)):
            offsets, data = W.raw(batch.column("text"))
            texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group_of(_ids(batch.column("doc_id")), groups), pa.int32()), pa.array(np.ones(len(texts)), pa.int32()),
                 batch.column("doc_id").cast(pa.int64()), pa.array([copy_of(t) for t in texts], pa.int64()), pa.array([press.compress(t) for t in texts], pa.binary())],
                ["grp", "turn", "doc_id", "copy", "body"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` per row of ``doc_id, text``: the removed byte ranges and the bytes that stay."""
    spark = docs.sparkSession
    stages = Stages(spark, "suffixes")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards, groups = max(least, tasks_for(total, 32 << 20)), max(least, tasks_for(total, 16 << 20))
    texts = docs.mapInArrow(_texts(groups), ROWS)

    def met(blobs: DataFrame) -> DataFrame:
        given = blobs.select("grp", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("copy"), "body")
        return given.union(texts).repartitionById(groups, "grp").sortWithinPartitions("turn")

    dealt = docs.mapInArrow(_find(length, shards, groups), _BLOB).repartitionById(shards, "grp").sortWithinPartitions("grp")
    places = stages.write(dealt.mapInArrow(_settle(groups), _BLOB), "places")
    contexts = met(places).mapInArrow(_contexts(length, shards), _BLOB).repartitionById(shards, "grp").sortWithinPartitions("grp")
    intervals = stages.write(contexts.mapInArrow(_intervals(length, groups), _BLOB), "intervals")
    return met(intervals).mapInArrow(_removed, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def repeat_report(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row per document: how much goes, in how many runs, and a digest of what stays."""
    return remove_repeats(docs, length).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


REPEAT_SQL = """
WITH b AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM b)),
m AS (SELECT s, MIN(doc_id) AS first_doc FROM w GROUP BY s),
d AS (SELECT w.doc_id, w.i, w.i > LAG(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) + 50 AS breaks FROM w JOIN m ON w.s = m.s WHERE m.first_doc < w.doc_id),
n AS (SELECT doc_id, i, SUM(CASE WHEN breaks THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM d),
spans AS (SELECT doc_id, run, MIN(i) AS low, MAX(i) + 50 AS high FROM n GROUP BY doc_id, run),
cut AS (SELECT doc_id, low, high, COALESCE(LAG(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS at FROM spans),
heads AS (
  SELECT c.doc_id, string_agg(substr(b.h, 2 * c.at + 1, 2 * (c.low - c.at)), '' ORDER BY c.low) AS kept, MAX(c.high) AS last,
    SUM(c.high - c.low) AS removed, COUNT(*) AS n FROM cut c JOIN b ON c.doc_id = b.doc_id GROUP BY c.doc_id
)
SELECT b.doc_id, CAST(len(b.h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(h.removed, 0) AS BIGINT) AS n_removed,
  CAST(COALESCE(h.n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN h.doc_id IS NULL THEN b.h ELSE h.kept || substr(b.h, 2 * h.last + 1) END)) AS kept_sha256
FROM b LEFT JOIN heads h ON b.doc_id = h.doc_id
"""
def _documents(batches, found: dict, columns: int):
    """Reads blobs into ``found`` and passes documents: (id, copy, compressed text)."""
    for batch in batches:
        for turn, doc_id, copy, body in zip(*(batch.column(c).to_pylist() for c in ("turn", "doc_id", "copy", "body")), strict=True):
            if turn:
                yield (NO_ID if doc_id is None else doc_id), copy, body
                continue
            ids, copies, doc, *values = unpack(body, np.int64, np.int64, np.int32, *[np.int32] * columns)
            doc = np.cumsum(doc, dtype=np.int64)
            values = [np.cumsum(v, dtype=np.int64) for v in values]
            edges = np.searchsorted(doc, np.arange(len(ids) + 1))
            for k in range(len(ids)):
                found.setdefault((int(ids[k]), int(copies[k])), []).append([v[edges[k] : edges[k + 1]] for v in values])
