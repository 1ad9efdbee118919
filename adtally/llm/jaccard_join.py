"""N-gram Jaccard self-join of documents by rare-first prefix filtering, and its components.

A document's set holds the hashes of its shingles. Sets are compared in one global order of
shingles, rare ones first. Two sets reach a Jaccard similarity of ``percent`` only if their
prefixes, the first ``n - ceil(t n) + 1`` shingles, share one, so documents meet on prefix
shingles alone. Pairs that meet pass a length filter and a positional filter (how much overlap
the two places still allow), then, once from all shingles, a suffix filter (how much the sizes of
the parts of both sets by hash allow, from sketches that are joined to the pairs) and are verified
once, on whole sets. So what a document sends with each prefix shingle is its key and its size.

* Order: document frequencies are summed over all documents in a table with a cell per shingle hash
  modulo its size. Shingles are ordered by (cell count, hash). Any total order gives the same
  pairs; the table has at most 2 ** 24 cells (64 MB) whatever the input, so it can be broadcast.
* Equal sets are one class from the start; only the classes are joined.
* The classes that share a shingle are filtered pair by pair in memory if they are at most ``PAIRED``.
  If what passes is in proportion to their number, those pairs are kept. A group as dense as near copies are is looked at once more with
  sketches (parts in proportion to the set, so that the suffix filter is as sharp for long sets as for short ones): members with few
  partners leave it with all their pairs. Pairs from all groups are made distinct, pass the sketches, and are verified.
* In what is left of a dense group, and in groups larger than that, every class meets a few hubs first, those that have the shingle earliest; components follow from the
  links found, and only groups that still hold several components get new hubs, four times as many in
  each round and more where few pairs pass, until all members of a group are connected or each has been a hub. So a
  group of near copies costs a few comparisons per member, and no link between two
  components is missed. Members of one component need no further comparison.
* Groups too large for one task are dealt over several by (shingle, salt) and take part from the
  second step on. Hubs with many partners are salted in the verification, too.

Texts are shuffled once per round, and only of classes that have a candidate: a bitmap of their hashed ids, of at most 16 MB,
leaves all but a few of the others where they are. Sets travel once, to their hubs. Partial document frequencies are sent compressed.

Defined cases: NULL, empty and wordless texts have no shingles and link with nothing, not even
each other; fewer words than a shingle make one shingle of all words; repeated ids are
rows of their own; a NULL id takes part and shows its class's least id, if there is one.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm import words as W
from adtally.llm.common import Stages, tasks_for
from adtally.llm.components import components

PARTS = 64
CELL_BITS = (16, 24)
SMALL = 8
PAIRED = 4096
TRIED_AT_ONCE = 1 << 18
FIRST_HUBS = 4
FEW_PAIRS = 4
GROUP_ROWS = 200_000
PAIRS_PER_TASK = 2_000
SPREAD = 64
LONE_PAIRS = 64
LEAST_PARTS = 256
TOKEN_BYTES = 6
SEEN_BITS = (15, 27)


class Sets:
    """Shingle sets of the texts of a batch: sorted hashes, text by text."""

    def __init__(self, column: pa.Array, shingle: int):
        offsets, data = W.raw(column)
        starts, ends, first = W.spans(data, offsets, W.SPACED)
        words = W.hash_words(data, starts, ends)
        n = len(first) - 1
        runs = W.hash_runs(words, shingle)
        owner = W.owners(first)[: len(runs)]
        whole = np.arange(len(runs)) + shingle <= first[owner + 1]
        runs, owner = runs[whole], owner[whole]
        few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < shingle))
        if len(few):
            own = [W.hash_runs(words[first[k] : first[k + 1]], int(first[k + 1] - first[k])) for k in few]
            runs, owner = np.concatenate([runs, *own]), np.concatenate([owner, few])
        order = np.lexsort((runs, owner))
        runs, owner = runs[order], owner[order]
        fresh = np.ones(len(runs), bool)
        fresh[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
        self.hashes, self.owner = runs[fresh], owner[fresh]
        self.begin = np.searchsorted(self.owner, np.arange(n + 1))
        self.sizes = np.diff(self.begin)

    def of(self, k: int) -> np.ndarray:
        return self.hashes[self.begin[k] : self.begin[k + 1]]

    def sketch(self, k: int) -> bytes | None:
        """Sizes of the set's parts by hash, at least a part for every two members; as many parts as bytes, a power of two."""
        n = int(self.sizes[k])
        if not n:
            return None
        level = max(LEAST_PARTS.bit_length() - 1, (n - 1).bit_length() - 1)
        sizes = np.bincount((self.of(k) >> np.uint64(64 - level)).astype(np.int64), minlength=1 << level)
        return np.minimum(sizes, 255).astype(np.uint8).tobytes()

    def digest(self, k: int) -> bytes | None:
        """128 bits that stand for the set."""
        return hashlib.blake2b(self.of(k).tobytes(), digest_size=16).digest() if self.sizes[k] else None


def needed(size: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap with any similar set: ceil(size * percent / 100)."""
    return -(-size * percent // 100)


def cells_for(n_bytes: int) -> int:
    """Size of the frequency table: about a cell per hundred shingles, within fixed bounds."""
    return 1 << min(max(int(n_bytes // 768).bit_length(), CELL_BITS[0]), CELL_BITS[1])


def described(docs: DataFrame, shingle: int, size: int) -> DataFrame:
    """``doc_id, n, digest`` per document, and per task partial document frequencies as ``part, cells``."""
    step = size // PARTS

    def run(batches):
        cells, press = np.zeros(size, np.uint32), _press()
        for batch in (part for whole in batches for part in W.slices(whole)):
            sets = Sets(batch.column("text"), shingle)
            cells += np.bincount(sets.hashes & np.uint64(size - 1), minlength=size).astype(np.uint32)
            n, nothing = batch.num_rows, pa.nulls(batch.num_rows, pa.int32())
            digests = [sets.digest(k) for k in range(n)]
            yield _columns(
                batch.column("doc_id"), pa.array(sets.sizes), pa.array(digests, pa.binary()), pa.array([_key(d) for d in digests], pa.int64()),
                pa.array([sets.sizes[k] and press(np.frombuffer(sets.sketch(k), np.uint8)) or None for k in range(n)], pa.binary()), nothing, pa.nulls(n, pa.binary()), _DESCRIBED,
            )
        parts = [press(planes(cells[k * step : (k + 1) * step])) for k in range(PARTS)]
        yield _columns(
            pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.binary()), pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.binary()),
            pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary()), _DESCRIBED,
        )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, key long, sketch binary, part int, cells binary")


_DESCRIBED = ["doc_id", "n", "digest", "key", "sketch", "part", "cells"]


def _key(digest: bytes | None) -> int | None:
    """The part of a digest that prefix tuples carry."""
    return int.from_bytes(digest[:8], "little", signed=True) if digest else None


def _columns(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(values[:-1]), values[-1])


def planes(counts: np.ndarray) -> np.ndarray:
    """32-bit counts with their lowest bytes first, then the second ones and so on: small counts compress to a few bits."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """The summed table of ``size`` numbers."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells"), strict=True):
                values = from_planes(coder.decompress(cells.as_buffer())).astype(np.int64)
                sums[part] = sums[part] + values if part in sums else values
        parts = sorted(sums)
        yield _columns(pa.array(parts, pa.int32()), pa.array([sums[p].tobytes() for p in parts], pa.binary()), ["part", "cells"])

    summed = rows.where("part is not null").select("part", "cells").repartition(PARTS, "part").mapInArrow(add, "part int, cells binary")
    out = np.zeros(size, np.int64)
    for row in summed.collect():
        own = np.frombuffer(row.cells, np.int64)
        out[row.part * len(own) : (row.part + 1) * len(own)] = own
    return np.minimum(out, np.iinfo(np.uint32).max).astype(np.uint32)


_TUPLES = "bucket int, salted boolean, key binary, n binary, token binary, doc binary, place binary"


def prefix_tuples(docs: DataFrame, shingle: int, percent: int, cells, buckets: int) -> DataFrame:
    """Prefix shingles dealt into buckets by shingle, as packed columns: per bucket its documents and their (shingle, document, place)."""

    def run(batches):
        count, seen = cells.value, set()
        press = _press()
        usual = 2 * float(count.mean())  # what unrelated shingles add to a cell
        for batch in (part for whole in batches for part in W.slices(whole, limit=4 * W.SLICE_BYTES)):
            sets = Sets(batch.column("text"), shingle)
            n = sets.sizes
            digests = [sets.digest(k) for k in range(len(n))]
            # an equal set met before in this task adds nothing
            fresh = np.zeros(len(n), bool)
            for k, digest in enumerate(digests):
                if digest is not None and digest not in seen:
                    fresh[k] = True
                    seen.add(digest)
            rarity = count[sets.hashes & np.uint64(len(count) - 1)]
            order = np.argsort((sets.owner.astype(np.int64) << 32) | rarity, kind="stable")
            token, doc, rare = sets.hashes[order] >> np.uint64(8 * (8 - TOKEN_BYTES)), sets.owner[order], rarity[order]
            place = np.arange(len(token)) - sets.begin[doc]
            use = fresh[doc] & (place < (n - needed(n, percent) + 1)[doc])
            token, doc, place, rare = token[use], doc[use], place[use].astype(np.int32), rare[use]
            key = np.array([_key(d) or 0 for d in digests], np.int64)
            # a group that may be too large for one task is spread over several
            salts = (np.maximum(rare - usual, 0) // GROUP_ROWS).astype(np.uint64)
            salt = np.where(salts > 0, key[doc].astype(np.uint64) % (salts + np.uint64(1)), np.uint64(0))
            bucket = (W.mixed(token + salt) % np.uint64(buckets)).astype(np.int64) * 2 + (salts > 0)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(2 * buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)):
                own = order[edges[b] : edges[b + 1]]
                used, local = np.unique(doc[own], return_inverse=True)
                rows.append((
                    int(b // 2), bool(b % 2), key[used].tobytes(), press(n[used].astype(np.int32)),
                    packed(token[own]), press(local.astype(np.int32)), press(place[own]),
                ))
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW_TUPLES.names, r, strict=True)) for r in rows], _ARROW_TUPLES)

    return docs.select("text").mapInArrow(run, _TUPLES)


_PACKED = ("key", "n", "token", "doc", "place")
_ARROW_TUPLES = pa.schema(
    [("bucket", pa.int32()), ("salted", pa.bool_())] + [(c, pa.binary()) for c in _PACKED]
)


def _press():
    """Compression of columns that repeat; hashes are sent as they are."""
    coder = zstandard.ZstdCompressor(level=1)
    return lambda array: coder.compress(np.ascontiguousarray(array).tobytes())


def packed(tokens: np.ndarray) -> bytes:
    """The low ``TOKEN_BYTES`` bytes of each number."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    low = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :TOKEN_BYTES] = low
    return out.view("<u8").ravel()


class Members:
    """(shingle, document, place) rows of one bucket, sorted by shingle and place."""

    def __init__(self, rows: list[dict]):
        coder = zstandard.ZstdDecompressor()
        rows = [{c: coder.decompress(r[c]) if c in ("n", "doc", "place") else r[c] for c in _PACKED} for r in rows]

        def column(name, kind):
            return np.concatenate([np.frombuffer(r[name], kind) for r in rows]) if rows else np.zeros(0, kind)

        shift = np.cumsum([0, *(len(r["key"]) // 8 for r in rows)])
        self.key, self.n = column("key", np.int64), column("n", np.int32).astype(np.int64)
        doc = column("doc", np.int32).astype(np.int64) + np.repeat(shift[:-1], [len(r["doc"]) // 4 for r in rows])
        token, place = unpacked(b"".join(r["token"] for r in rows)), column("place", np.int32).astype(np.int64)
        # rows of equal sets from other tasks go; then shingles that one set alone has
        order = np.lexsort((self.key[doc], place, token))
        token, place, doc = token[order], place[order], doc[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (self.key[doc[1:]] != self.key[doc[:-1]])
        token, place, doc = token[fresh], place[fresh], doc[fresh]
        shared = np.zeros(len(token), bool)
        shared[1:] = token[1:] == token[:-1]
        shared[:-1] |= shared[1:]
        self.token, self.place, self.doc = token[shared], place[shared], doc[shared]
        self.single = (token[~shared], place[~shared], doc[~shared])


def near_enough(na, nb, pa_, pb, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Length and positional filters: could these pairs still be similar? And the overlap that they need."""
    low, high = np.minimum(na, nb), np.maximum(na, nb)
    least = -(-percent * (na + nb) // (100 + percent))
    most = np.minimum(pa_, pb) + 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return (100 * low >= percent * high) & (most >= least), least


class Sketches:
    """The suffix filter with parts in proportion to a set's size, from compressed sketches. A finer sketch is added up to
    compare it with a coarser one."""

    def __init__(self, sketches: list[bytes]):
        coder = zstandard.ZstdDecompressor()
        sketches = [coder.decompress(x) for x in sketches]
        self.level = np.array([len(x).bit_length() - 1 for x in sketches], np.int64)
        self.rows: dict[int, np.ndarray] = {}
        self.place = {}
        for level in sorted(set(self.level.tolist()), reverse=True):
            own = np.flatnonzero(self.level == level)
            table = np.frombuffer(b"".join(sketches[k] for k in own), np.uint8).reshape(len(own), 1 << level).astype(np.int32)
            table[table == 255] = 1 << 20  # 255 or more, which bounds nothing
            finer = self.rows.get(level + 1)
            if finer is not None:  # sets within the length bound are a level apart at most
                above = self.place[level + 1]
                own, table = np.concatenate([own, above]), np.concatenate([table, finer.reshape(len(finer), -1, 2).sum(axis=2, dtype=np.int32)])
            self.rows[level], self.place[level] = table, own
        self.at = {}
        for level, own in self.place.items():
            index = np.full(len(sketches), -1, np.int64)
            index[own] = np.arange(len(own))
            self.at[level] = index

    def share(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most that each pair of sets can have in common; pairs more than a level apart are not bounded."""
        out = np.full(len(a), np.iinfo(np.int64).max)
        level = np.minimum(self.level[a], self.level[b])
        for k in np.unique(level).tolist():
            own = np.flatnonzero(level == k)
            x, y = self.at[k][a[own]], self.at[k][b[own]]
            known = (x >= 0) & (y >= 0)
            own, x, y = own[known], x[known], y[known]
            step = max(1, (8 << 20) >> (k + 2))
            for low in range(0, len(own), step):
                part = slice(low, low + step)
                out[own[part]] = np.minimum(self.rows[k][x[part]], self.rows[k][y[part]]).sum(axis=1)
        return out


def _pairs(m: Members, percent: int, paired: int) -> tuple[np.ndarray, ...]:
    """Pairs of rows that pass the filters, which rows belong to groups with more such pairs than these, the rows' ranks and the sizes of their groups."""
    edges = np.flatnonzero(np.concatenate([[True], m.token[1:] != m.token[:-1], [True]])) if len(m.token) else np.zeros(1, np.int64)
    size = np.diff(edges)
    rank = np.arange(len(m.token)) - np.repeat(edges[:-1], size)
    dense = np.repeat(size > SMALL, size)
    left, right = [], []

    def passing(a, b):
        da, db = m.doc[a], m.doc[b]
        good, _ = near_enough(m.n[da], m.n[db], m.place[a], m.place[b], percent)
        left.append(a[good])
        right.append(b[good])

    for k in np.flatnonzero((size > SMALL) & (size <= paired)):
        own = np.arange(edges[k], edges[k + 1])
        # rows are tried in order of size, against those within the length bound, until there are too many pairs
        own = own[np.argsort(m.n[m.doc[own]], kind="stable")]
        n = m.n[m.doc[own]]
        reach = np.searchsorted(n, 100 * n // percent, "right") - np.arange(len(own)) - 1
        tried, found, kept, low = np.cumsum(reach), 0, len(left), 0
        while low < len(own) and found <= FEW_PAIRS * len(own):
            high = max(low + 1, int(np.searchsorted(tried, tried[low] - reach[low] + TRIED_AT_ONCE, "right")))
            part = reach[low:high]
            a = np.repeat(np.arange(low, high), part)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(part) - part, part)
            passing(own[a], own[b])
            found, low = found + len(left[-1]), high
        if found <= FEW_PAIRS * len(own):
            dense[own] = False
        else:
            del left[kept:], right[kept:]
    for hub in range(SMALL - 1):
        later = np.flatnonzero((rank > hub) & (np.repeat(size <= SMALL, size) | dense & (hub < FIRST_HUBS)))
        passing(later - rank[later] + hub, later)
    return np.concatenate(left), np.concatenate(right), dense, rank, np.repeat(size, size)


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    order = np.lexsort((b, a))
    pairs = np.stack([a[order], b[order]])
    return pairs[:, np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))] if len(a) else pairs


def _apart(n, place, sketches: Sketches, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a dense group, in order of place: all pairs of the members that have few partners in it, and which members those are.

    Members that pass with a hub, or with several of a few members spread over the group, are copies at once. Each other member is held
    against the whole group and stays apart if few pass. The copies that are left meet in rounds, without the others.
    """
    every = np.arange(len(n))

    def passing(a, b):
        good, least = near_enough(n[a], n[b], place[a], place[b], percent)
        at = np.flatnonzero(good & (a != b))
        at = at[sketches.share(a[at], b[at]) >= least[at]]
        return a[at], b[at]

    copies = every < FIRST_HUBS
    for others, least in ((every[:FIRST_HUBS], 1), (np.unique(np.linspace(0, len(n) - 1, SPREAD).astype(np.int64)), 2)):
        a, _ = passing(np.repeat(every, len(others)), np.tile(others, len(n)))
        copies = copies | (np.bincount(a, minlength=len(n)) >= least)
    lone, found = every[~copies], []
    step = max(1, TRIED_AT_ONCE // len(n))
    for low in range(0, len(lone), step):
        part = lone[low : low + step]
        found.append(passing(np.repeat(part, len(n)), np.tile(every, len(part))))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (every[:0], every[:0])
    apart = ~copies & (np.bincount(a, minlength=len(n)) <= LONE_PAIRS)
    return a[apart[a]], b[apart[a]], apart


def parted(groups: DataFrame, percent: int) -> DataFrame:
    """Groups of at most ``PAIRED`` members (``token, place, n, key, rep, hub, cuts``, with whole sketches as cuts) without the members
    that have few partners, whose pairs come out as ``a, b``. Hubs are those that met the others before."""

    def group(rows):
        token, place, n, key, rep, hub = (np.array([r[k] for r in rows]) for k in range(6))
        cuts = [r[6] for r in rows]
        a, b, apart = _apart(n, place, Sketches(cuts), percent)
        yield _found(_unique_pairs(np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])))
        left = np.flatnonzero(~apart)
        yield _members(token[left], place[left], n[left], key[left], rep[left], hub[left], [cuts[k] for k in left])

    return _by_token(groups.select("token", "place", "n", "key", "rep", "hub", "cuts"), group)


def _found(pairs: np.ndarray) -> pa.RecordBatch:
    return _columns(pa.array(pairs[0]), pa.array(pairs[1]), *(pa.nulls(pairs.shape[1], t) for t in _REST), _FOUND)


def _members(token, place, n, key, rep, hub, cuts: list[bytes]) -> pa.RecordBatch:
    nothing = pa.nulls(len(key), pa.int64())
    return _columns(nothing, nothing, *(pa.array(x) for x in (token, place, n, key, rep, hub)), pa.array(cuts, pa.binary()), _FOUND)


def _by_token(rows: DataFrame, group) -> DataFrame:
    """Groups of bounded size, each whole and in order of place, handed to ``group`` as a list of rows."""

    def run(batches):
        open_, at = [], None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[0] != at and open_:
                    yield from group(open_)
                    open_ = []
                at = row[0]
                open_.append(row)
        if open_:
            yield from group(open_)

    return rows.repartition("token").sortWithinPartitions("token", "place", "n", "key").mapInArrow(run, _MET)


def hub_pairs(groups: DataFrame, percent: int, hubs: int) -> DataFrame:
    """Up to ``hubs`` new hubs of each group (``token, place, n, key, rep, hub, c, cuts``, with components as ``c``) and the pairs of
    each with members of other components that pass the filters. More become hubs while what passes is in proportion to the group.

    Hubs are members outside the group's largest component, spread by a hash of their keys. Of two members in different components
    at least one is outside the largest, so a group is done when all of those have been hubs. The members of the other groups
    come out again with their hubs marked.
    """

    def group(rows):
        token, place, n, key, rep, hub, c = (np.array([r[k] for r in rows]) for k in range(7))
        kinds, inverse = np.unique(c, return_inverse=True)
        outside = c != kinds[np.argmax(np.bincount(inverse))]
        fresh = np.flatnonzero(~hub & outside)
        if not len(fresh):
            return
        cuts, every = [r[7] for r in rows], np.arange(len(rows))
        sketches, found = Sketches(cuts), []
        spread = W.mixed(key[fresh].view(np.uint64) * np.uint64(2 * hubs + 1))
        fresh = fresh[np.argsort(spread, kind="stable")]
        step, most, low, passed = max(1, TRIED_AT_ONCE // len(rows)), hubs, 0, 0
        while low < min(most, len(fresh)):
            part = fresh[low : min(low + step, most)]
            a, b = np.repeat(part, len(rows)), np.tile(every, len(part))
            good, least = near_enough(n[a], n[b], place[a], place[b], percent)
            at = np.flatnonzero(good & (c[a] != c[b]))
            at = at[sketches.share(a[at], b[at]) >= least[at]]
            found.append((rep[a[at]], rep[b[at]]))
            low, passed = low + len(part), passed + len(at)
            if low == most and passed <= FEW_PAIRS * len(rows):
                most = 2 * most
        yield _found(_unique_pairs(*(np.concatenate(x) for x in zip(*found, strict=True))))
        hub[fresh[:low]] = True
        if (~hub & outside).any():
            yield _members(token, place, n, key, rep, hub, cuts)

    return _by_token(groups.select("token", "place", "n", "key", "rep", "hub", "c", "cuts"), group)


_PAIR = "a long, b long"
_MET = "a long, b long, token long, place long, n long, key long, rep long, hub boolean, cuts binary"


def candidates(tuples: DataFrame, buckets: int, percent: int, paired: int = PAIRED) -> DataFrame:
    """``a, b`` pairs (``token`` NULL) and rows of dense groups (``token, place, n, key, hub``) for later rounds, ``large`` where the
    group has more than ``PAIRED`` members."""

    def run(batches):
        open_, at = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if at is not None and (row["bucket"], row["salted"]) != at:
                    yield from bucket(open_, at[1])
                    open_ = []
                at = (row["bucket"], row["salted"])
                open_.append(row)
        if open_:
            yield from bucket(open_, at[1])

    def bucket(rows, salted):
        m = Members(rows)
        a, b, big, rank, size = _pairs(m, percent, paired)
        if salted:  # part of a group: pairs come in later rounds
            a, b = a[:0], b[:0]
            token, place, doc = (np.concatenate(x) for x in zip((m.token, m.place, m.doc), m.single, strict=True))
            hub, large = np.zeros(len(token), bool), np.ones(len(token), bool)
        else:
            token, place, doc, hub, large = m.token[big], m.place[big], m.doc[big], rank[big] < FIRST_HUBS, size[big] > paired
        pairs = _unique_pairs(m.key[m.doc[a]], m.key[m.doc[b]])
        yield _columns(pa.array(pairs[0]), pa.array(pairs[1]), *(pa.nulls(pairs.shape[1], t) for t in _OPEN_REST), _OPEN)
        yield _columns(
            pa.nulls(len(token), pa.int64()), pa.nulls(len(token), pa.int64()), pa.array(token.view(np.int64)), pa.array(place),
            pa.array(m.n[doc]), pa.array(m.key[doc]), pa.array(hub), pa.array(large), _OPEN,
        )

    # the rows of one bucket are packed and of bounded size; sorting brings them together
    dealt = tuples.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "salted")
    return dealt.mapInArrow(run, "a long, b long, token long, place long, n long, key long, hub boolean, large boolean")


_REST = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
_FOUND = ["a", "b", "token", "place", "n", "key", "rep", "hub", "cuts"]
_OPEN_REST = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
_OPEN = ["a", "b", "token", "place", "n", "key", "hub", "large"]


def sketched(pairs: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` pairs of keys whose sketches allow the overlap they need, as pairs of document ids."""

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
            both = Sketches([*batch.column("ca").to_pylist(), *batch.column("cb").to_pylist()])
            at = np.arange(len(na))
            good = pa.array(both.share(at, at + len(na)) >= -(-percent * (na + nb) // (100 + percent)))
            yield _columns(batch.column("ra").filter(good), batch.column("rb").filter(good), ["a", "b"])

    one, two = (named.select(*[F.col(c).alias(f"{c[0]}{x}") for c in ("key", "n", "rep")], F.col("sketch").alias(f"c{x}")) for x in "ab")
    known = pairs.join(one, F.col("a") == F.col("ka")).join(two, F.col("b") == F.col("kb")).select("ra", "rb", "na", "nb", "ca", "cb")
    return known.mapInArrow(run, _PAIR)


def unmet(pairs: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """The ``a, b`` pairs of two ids that ``done`` has neither way round; a pair found from both sides stays once."""

    def sided(found: DataFrame, old: bool) -> DataFrame:
        return found.where("a != b").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", F.lit(old).alias("old"))

    both = sided(pairs, False) if done is None else sided(pairs, False).union(sided(done, True))
    once = both.groupBy("x", "y").agg(F.min("a").alias("a"), F.max("old").alias("old")).where("not old")
    return once.select("a", F.when(F.col("a") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("b"))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def marked(pairs: DataFrame) -> np.ndarray:
    """A bitmap with the hashes of all ids in ``a, b`` pairs: at least 16 bits for each id, up to 2 ** 27 bits (16 MB).

    An id whose bit is not set is in no pair; the others are looked up by a join.
    """
    bits = 1 << min(max((32 * pairs.count()).bit_length(), SEEN_BITS[0]), SEEN_BITS[1])
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).select((F.pmod(F.xxhash64(F.col("id").cast("long")), F.lit(bits)) + 1).alias("cell"))
    # positions are numbered from 1, and so are the buckets of 4096 bytes
    maps = ids.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    out = np.zeros(bits >> 3, np.uint8)
    for row in maps.collect():
        own = np.frombuffer(row.bits, np.uint8)
        out[(row.bucket - 1) * len(own) :][: len(own)] = own
    return out


def wanted_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc_id, body``: compressed texts of the documents in ``a, b`` pairs, and of few others."""
    seen = docs.sparkSession.sparkContext.broadcast(marked(pairs))
    cell = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(8 * len(seen.value)))

    def press(batches):
        coder = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            at = whole.column("cell").to_numpy()
            marks = (seen.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            for batch in W.slices(whole.filter(pa.array(marks == 1))):
                offsets, data = W.raw(batch.column("text"))
                body = [coder.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield _columns(batch.column("doc_id"), pa.array(body, pa.binary()), ["doc_id", "body"])

    return docs.select("doc_id", "text", cell.alias("cell")).mapInArrow(press, "doc_id long, body binary")


def verified(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The ``a, b`` pairs of document ids whose sets are similar; every pair is compared once, on whole sets.

    Pairs are always shuffled to their texts: with few of them broadcast, a task would run one Python worker for texts and another
    for sets, and an executor goes on with as many workers as it once had at a time, each with its memory.
    Rows of one id are one document: it is similar if one of its texts is. Sets travel to the pair's hub ``a``; a hub with many partners is dealt over salts.
    """
    load = pairs.groupBy("a").agg(F.floor(F.count("*") / PAIRS_PER_TASK).cast("int").alias("salts"))
    salted = pairs.join(load, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts") + 1).cast("int").alias("salt"))
    own = load.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), "salts")).alias("salt"))
    wanted = salted.union(own).groupBy("b").agg(F.collect_list(F.struct("a", "salt")).alias("to"))

    def send(batches):
        coder = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in _few(whole)):
            sets = Sets(pa.array([coder.decompress(x.as_buffer()) for x in batch.column("body")], pa.binary()).cast(pa.string()), shingle)
            rows = [
                (to["a"], to["salt"], doc != to["a"], doc, sets.of(k).tobytes())
                for k, (doc, targets) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("to").to_pylist(), strict=True))
                for to in targets
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(_SENT.names, r, strict=True)) for r in rows], _SENT)

    def compare(batches):
        hub, mine, met = None, [], False
        for batch in batches:
            found = []
            for a, member, b, own in zip(*(batch.column(c) for c in ("a", "member", "b", "own")), strict=True):
                theirs = np.frombuffer(own.as_buffer(), np.uint64)
                if not member.as_py():
                    mine = [*mine, theirs] if hub == a.as_py() and not met else [theirs]
                    hub, met = a.as_py(), False
                    continue
                met = True
                if any(similar(x, theirs, percent) for x in mine):
                    found.append((hub, b.as_py()))
            yield _columns(*(pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)), ["a", "b"])

    sent = wanted_texts(docs, pairs).join(wanted.hint("merge"), F.col("doc_id") == F.col("b")).select("doc_id", "body", "to").mapInArrow(send, "a long, salt int, member boolean, b long, own binary")
    ready = sent.repartition(F.col("a"), F.col("salt")).sortWithinPartitions("a", "salt", "member")
    return ready.mapInArrow(compare, _PAIR)


def _few(batch: pa.RecordBatch, rows: int = 256):
    return (batch.slice(low, rows) for low in range(0, batch.num_rows, rows))


_SENT = pa.schema([("a", pa.int64()), ("salt", pa.int32()), ("member", pa.bool_()), ("b", pa.int64()), ("own", pa.binary())])


def _with_components(groups: DataFrame, comps: DataFrame) -> DataFrame:
    return groups.join(comps, F.col("rep") == F.col("node"), "left").select(*groups.columns, F.coalesce("component", "rep").alias("c"))


def _alive(known: DataFrame) -> DataFrame:
    """Of groups with components ``c``, those that still have a member which was no hub outside their largest component, with that one as ``top``."""
    parts = known.groupBy("token", "c").agg(F.count("*").alias("n"), F.sum((~F.col("hub")).cast("long")).alias("left"))
    tops = parts.groupBy("token").agg(F.max(F.struct("n", "c", "left")).alias("top"), F.sum("left").alias("left"))
    alive = tops.where(F.col("left") > F.col("top.left")).select(F.col("token").alias("t"), F.col("top.c").alias("top"))
    return known.join(alive, F.col("token") == F.col("t")).drop("t")


def _large_hubs(going: DataFrame, named: DataFrame, stages: Stages, hubs: int, percent: int) -> DataFrame:
    """``hub_pairs`` for groups that may not fit a task: hubs and members meet in a join, which splits hot groups."""
    salt = F.pmod(F.xxhash64("key", F.lit(hubs)), F.lit(hubs))
    first = F.min(F.struct("place", "n", "key", "c")).alias("h")
    others = going.where(~F.col("hub") & (F.col("c") != F.col("top")))
    chosen = stages.write(others.groupBy("token", salt.alias("salt")).agg(first).select(F.col("token").alias("t"), "h.*"), "hubs")
    h = chosen.select("t", *[F.col(c).alias(f"h_{c}") for c in ("place", "n", "key", "c")])
    low, high = F.least("n", "h_n"), F.greatest("n", "h_n")
    most = F.least("place", "h_place") + 1 + F.least(F.col("n") - F.col("place"), F.col("h_n") - F.col("h_place")) - 1
    fits = (100 * low >= percent * high) & (most * (100 + percent) >= percent * (F.col("n") + F.col("h_n")))
    met = going.join(h, (F.col("token") == F.col("t")) & (F.col("c") != F.col("h_c")) & fits)
    pairs = sketched(met.select(F.col("h_key").alias("a"), F.col("key").alias("b")).distinct(), named, percent)
    marks = chosen.select(F.col("t").alias("ht"), F.col("key").alias("hk"))
    rest = going.join(marks, (F.col("token") == F.col("ht")) & (F.col("key") == F.col("hk")), "left")
    kept = rest.select("token", "place", "n", "key", "rep", (F.col("hub") | F.col("hk").isNotNull()).alias("hub"))
    blank = [F.lit(None).cast("long").alias(c) for c in ("a", "b")]
    return kept.select(*blank, *kept.columns).unionByName(pairs, allowMissingColumns=True)


def similar_documents(docs: DataFrame, shingle: int = 5, percent: int = 80, paired: int = PAIRED) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``doc_id, text``; groups of more than ``paired`` members are joined, not held in memory."""
    spark = docs.sparkSession
    stages = Stages(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = cells_for(docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    rows = stages.write(described(docs, shingle, size), "described")
    cells = spark.sparkContext.broadcast(frequencies(rows, size))
    sets = rows.where("digest is not null")
    rows = rows.where("part is null").select("doc_id", "n", "digest")
    shingles = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # a class: documents with the same set, under the least id
    classes = sets.groupBy("digest").agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("key", "n", "sketch")])
    classes = stages.write(classes, "classes")
    named = classes.where("rep is not null").select("key", "rep", "n", "sketch")
    buckets = max(tasks_for(shingles * 4, 8 << 20), int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = stages.write(candidates(prefix_tuples(docs, shingle, percent, cells, buckets), buckets, percent, paired), "met")
    cells.destroy()

    members = met.where("token is not null").join(named.select(F.col("key").alias("k"), "rep", F.col("sketch").alias("cuts")), F.col("key") == F.col("k"))
    opened = stages.write(parted(members.where("not large"), percent), "opened")
    large = members.where("large").select("token", "place", "n", "key", "rep", "hub")
    large = None if met.where("large").isEmpty() else stages.write(large, "large")
    once = met.where("token is null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = done = stages.write(unmet(sketched(once, named, percent).union(opened.where("token is null").select("a", "b"))), "pairs")
    stages.drop(met)
    opened = opened.where("token is not null")
    comps, hubs, small = None, 4 * FIRST_HUBS, None if opened.isEmpty() else opened.drop("a", "b")
    while True:
        fresh = stages.write(verified(docs, pairs, shingle, percent), "links")
        if comps is None or not fresh.isEmpty():
            stars = fresh if comps is None else fresh.union(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))
            comps = components(stars, stages)
        before, found = [t for t in (small, large) if t is not None], []
        if small is not None:
            small = stages.write(hub_pairs(_with_components(small, comps), percent, hubs), "groups")
            found.append(small.where("token is null").select("a", "b"))
            members = small.where("token is not null").drop("a", "b")
            small = None if members.isEmpty() else members
        if large is not None:
            going = stages.write(_alive(_with_components(large, comps)), "going")
            large = None if going.isEmpty() else stages.write(_large_hubs(going, named, stages, hubs, percent), "groups")
        if large is not None:
            found.append(large.where("token is null").select("a", "b"))
            large = large.where("token is not null").drop("a", "b")
        if not found:
            break
        pairs = stages.write(unmet(reduce(DataFrame.unionAll, found), done), "pairs")
        stages.drop(*before)
        done, hubs = done.union(pairs), 4 * hubs
    found = rows.join(classes.select(F.col("digest").alias("d"), "rep"), F.col("digest") == F.col("d"), "left")
    found = found.join(comps, F.col("rep") == F.col("node"), "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that belong to the component of a smaller id; equal ids keep all their rows."""
    found = similar_documents(docs, shingle, percent).where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(found, docs["doc_id"] == found["_gone"], "left_anti")


JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w
),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))
),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, MIN(r.other) AS component_id
FROM s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)
"""
