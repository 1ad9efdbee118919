"""Periodic runs of words by suffix trees, and texts with the repetitions of each run dropped.

A run is a stretch of consecutive words with a smallest period ``q`` (words ``q`` apart are equal), at
least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` words long, that no neighbouring word extends. Its words
after the first ``q`` are dropped from the collapsed text.

Method, per document, in a task. A suffix tree (Ukkonen) of the words and one of the reversed
words give longest common extensions of two positions, forward and backward, in constant time: an
Euler tour notes between successive leaves the string depth of their lowest common ancestor, and
the least depth between two leaves, from a sparse table, is the extension. The order of the leaves
ranks the suffixes, once with ascending and once with descending words; the next smaller rank ends
the longest Lyndon word at each position. Every run has a Lyndon root among those, so each is
a candidate period, extended in both directions; what is long enough is a run.

Trees are built of the stretches that may hold a run, not of whole texts. In a run the three words at any
place past the first period have occurred at most one period before. So places whose triple has
an earlier occurrence form stretches, a stretch of ``n`` places can only hold periods up to ``(n + 2) / 3``,
and places whose last occurrence is farther away fall out, until nothing changes. This loses no run at any length;
ordinary prose leaves nothing. A run is taken only if the whole text's neighbours do not extend it.

Memory: about 40 bytes a word for hashes and sorting in slices of whole texts, and about 650 bytes for each word of the longest stretch
(measured on 150,000 words; its two trees are built one after the other), so a single text costs as much as its longest repetitive stretch.

Defined cases: a NULL text has no words and an empty collapsed text; words are told apart byte by byte; a text of fewer than ``MIN_LENGTH`` words
has no run; repeated rows and NULL ids are rows like others; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm import words as W
from adtally.llm.sql import crc32

MIN_LENGTH, MIN_EXPONENT = 6, 4
GRAM = 3

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])


# --- stretches that may hold a run ---------------------------------------------------------


def last_seen(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How far back each run of ``GRAM`` words last occurred in its document; a large number where it did not."""
    far = np.iinfo(np.int64).max
    grams = W.hash_runs(h, GRAM)
    out = np.full(len(h), far)
    if not len(grams):
        return out
    whole = owner[: len(grams)] == owner[GRAM - 1 :]
    at = np.flatnonzero(whole)
    keyed = W.mixed(grams[at] ^ (owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keyed, kind="stable")
    same = keyed[order[1:]] == keyed[order[:-1]]
    out[at[order[1:][same]]] = at[order[1:][same]] - at[order[:-1][same]]
    return out


def stretches(back: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """``[low, high)`` ranges of places that may follow the first period of a run, after pruning by length."""
    alive = np.flatnonzero(back < np.iinfo(np.int64).max)
    while len(alive):
        breaks = np.flatnonzero((alive[1:] != alive[:-1] + 1) | (owner[alive[1:]] != owner[alive[:-1]])) + 1
        edges = np.concatenate([[0], breaks, [len(alive)]])
        size = np.repeat(np.diff(edges), np.diff(edges))
        # a run of period q leaves max(3 q - 2, MIN_LENGTH - q - 2) places, so three at least
        keep = (size >= GRAM) & (back[alive] <= (size + 2) // (MIN_EXPONENT - 1))
        if keep.all():
            return [(int(alive[a]), int(alive[b - 1]) + 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        alive = alive[keep]
    return []


# --- suffix tree ----------------------------------------------------------------------------


def suffix_tree(s: list[int]) -> tuple[array, array, array, dict[int, int]]:
    """Ukkonen's suffix tree of ``s``, whose last entry occurs nowhere else.

    Nodes are numbers, 0 the root; ``start`` and ``stop`` cut the label of the edge into a node out of ``s``. The edge from a
    node by its first word ``c`` is ``edges[node * (largest + 1) + c]``.
    """
    n, base = len(s), max(s) + 1
    start, stop, link = array("i", [0]), array("i", [0]), array("i", [0])
    edges: dict[int, int] = {}
    node, at, length, open_suffixes = 0, 0, 0, 0  # the active point: a node, an edge by its place in s, a length
    for i in range(n):
        c, fresh = s[i], 0  # fresh: the inner node made last, waiting for its link
        open_suffixes += 1
        while open_suffixes:
            if not length:
                at = i
            key = node * base + s[at]
            child = edges.get(key)
            if child is None:
                start.append(i), stop.append(n), link.append(0)
                edges[key] = len(start) - 1
                if fresh:
                    link[fresh] = node
                fresh = 0
            else:
                size = stop[child] - start[child]
                if length >= size:  # go down
                    at += size
                    length -= size
                    node = child
                    continue
                if s[start[child] + length] == c:  # the rest is in the tree already
                    if fresh and node:
                        link[fresh] = node
                    length += 1
                    break
                inner = len(start)
                start.append(start[child]), stop.append(start[child] + length), link.append(0)
                start.append(i), stop.append(n), link.append(0)
                edges[key] = inner
                start[child] += length
                edges[inner * base + s[start[child]]] = child
                edges[inner * base + c] = inner + 1
                if fresh:
                    link[fresh] = inner
                fresh = inner
            open_suffixes -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - open_suffixes + 1
    return start, stop, link, edges


class Suffixes:
    """Ranks of the suffixes of a word sequence and longest common extensions, from its suffix tree."""

    def __init__(self, s: list[int]):
        """``s`` holds positive numbers; 0 is put behind it and is less than all."""
        self.n = len(s)
        start, stop, _, edges = suffix_tree([*s, 0])
        base = max(s, default=0) + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        child = np.fromiter(edges.values(), np.int64, len(edges))
        size = np.frombuffer(stop, np.int32).astype(np.int64) - np.frombuffer(start, np.int32)
        parent, first = np.divmod(keys, base)
        self.inner = np.bincount(parent, minlength=len(size)) > 0
        self.size = size
        self.edges = parent, first, child
        order, self.between = self.tour(first)
        self.rank = np.empty(self.n + 1, np.int64)
        self.rank[order] = np.arange(self.n + 1)

    def tour(self, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour with children ordered by ``by``: suffixes as their leaves are met, and the string depth of the
        lowest node passed between each leaf and the one before."""
        parent, _, child = self.edges
        order = np.lexsort((-by, parent))  # the child to visit first is pushed last
        begins = np.searchsorted(parent[order], np.arange(len(self.size) + 1)).tolist()
        kids, size, inner = child[order].tolist(), self.size.tolist(), self.inner.tolist()
        leaves, between, low = array("i"), array("i"), 0
        nodes, depths = [0], [0]
        above = [0]  # depth of the parent
        whole = self.n + 1
        while nodes:
            v, depth, up = nodes.pop(), depths.pop(), above.pop()
            if up < low:
                low = up
            if inner[v]:
                own = kids[begins[v] : begins[v + 1]]
                nodes += own
                depths += [depth + size[k] for k in own]
                above += [depth] * len(own)
            else:
                leaves.append(whole - depth)
                between.append(low)
                low = depth
        return np.frombuffer(leaves, np.int32).astype(np.int64), np.frombuffer(between, np.int32)

    def falling_rank(self) -> np.ndarray:
        """Ranks when words are ordered downwards; the end stays less than all."""
        _, first, _ = self.edges
        order, _ = self.tour(np.where(first > 0, -first, np.iinfo(np.int64).min + 1))
        rank = np.empty(self.n + 1, np.int64)
        rank[order] = np.arange(self.n + 1)
        return rank

    def table(self) -> list[np.ndarray]:
        """Least of 1, 2, 4, ... successive entries of ``between``."""
        rows = [self.between]
        while 2 << (len(rows) - 1) <= len(self.between):
            half = 1 << (len(rows) - 1)
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        return rows

    def extensions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at ``a`` and ``b`` (different places)."""
        low, high = np.minimum(self.rank[a], self.rank[b]) + 1, np.maximum(self.rank[a], self.rank[b]) + 1
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for k, row in enumerate(self.table()):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the first later one of smaller rank (the end, ranked least, is one for all)."""
    rank = rank.tolist()
    out, waiting = [0] * (len(rank) - 1), []
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            out[waiting.pop()] = i
        waiting.append(i)
    return np.array(out, np.int64)


def runs_of(s: list[int], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Every run of a sequence of positive numbers as ``start, length, period`` rows, by start, then period.

    ``min_exponent`` is 2 at least, as shorter stretches have no root of their own.
    """
    n = len(s)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    tree = Suffixes(s)
    place = np.tile(np.arange(n), 2)
    root_end = np.concatenate([next_smaller(tree.rank), next_smaller(tree.falling_rank())])
    inside = root_end < n
    place, root_end = place[inside], root_end[inside]
    period = root_end - place
    right = tree.extensions(place, root_end)
    del tree
    left = np.zeros(len(place), np.int64)
    back = Suffixes(s[::-1])
    prior = np.flatnonzero(place > 0)
    left[prior] = back.extensions(n - place[prior], n - root_end[prior])
    found = np.stack([place - left, root_end + right - (place - left), period], axis=1)
    found = found[(found[:, 1] >= min_exponent * period) & (found[:, 1] >= min_length)]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


# --- documents ------------------------------------------------------------------------------


def _runs_in(words: list[bytes], low: int, high: int) -> list[tuple[int, int, int]]:
    """Runs of a document whose places past the first period lie in the stretch ``[low, high)``."""
    begin, end = max(0, low - (high - low + 2) // (MIN_EXPONENT - 1)), min(len(words), high + GRAM - 1)
    known: dict[bytes, int] = {}
    s = [known.setdefault(w, len(known) + 1) for w in words[begin:end]]
    found = []
    for start, length, period in runs_of(s).tolist():
        start += begin
        stop = start + length
        longer = (start > 0 and words[start - 1] == words[start - 1 + period]) or (stop < len(words) and words[stop] == words[stop - period])
        if not longer:
            found.append((start, length, period))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [words[k] for k in np.flatnonzero(~gone)]


def found_in(column: pa.Array) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """``runs, collapsed text`` of each text."""
    offsets, data = W.raw(column)
    starts, ends, first = W.spans(data, offsets, W.SPACED)
    owner = W.owners(first)
    per_text: dict[int, list[tuple[int, int]]] = {}
    # lower-casing inside the hash only adds stretches; words themselves are compared below
    for low, high in stretches(last_seen(W.hash_words(data, starts, ends), owner), owner):
        doc = int(owner[low])
        per_text.setdefault(doc, []).append((low - int(first[doc]), high - int(first[doc])))
    out = []
    for k in range(len(offsets) - 1):
        words = data[offsets[k] : offsets[k + 1]].tobytes().split()
        runs = sorted({r for low, high in per_text.get(k, ()) for r in _runs_in(words, low, high)}, key=lambda r: (r[0], r[2]))
        out.append((runs, b" ".join(collapse(words, runs) if runs else words)))
    return out


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed`` for every row of ``doc_id, text``: the runs by start, then period, and the text without their repetitions."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def run(batches):
        for batch in (part for whole in batches for part in W.slices(whole)):
            found = found_in(batch.column("text"))
            each = [r for runs, _ in found for r in runs]
            start, length, period = np.array(each, np.int64).reshape(-1, 3).T
            ends = np.concatenate([[0], np.cumsum([len(runs) for runs, _ in found])]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
            texts = pa.array([text for _, text in found], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), structs), texts], ["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _longest_first(a: Column, b: Column) -> Column:
    """Order of runs: longest, then by start, then by period."""
    later = F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
    return F.signum(F.when(a["length"] != b["length"], b["length"] - a["length"]).otherwise(later)).cast("int")


def report(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    best = F.get(F.array_sort("runs", _longest_first), F.lit(0))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    told = periodic_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    exponent = F.expr("best.length * 1000 div best.period").alias("exponent_milli")
    return told.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in which the words of every tenth document, by a checksum of its id, repeat from some place on.

    With ``h`` the CRC-32 of the id and ``g = h div 10``: where ``h`` is a multiple of 10, word ``i`` from ``a = g mod n`` on becomes
    word ``a + (i - a) mod p``, ``p = 1 + (n - a) div (3 + g mod 8)``.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    cut = docs.select("doc_id", "text", F.when(chosen, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    a = F.when(n > 0, F.col("g") % n).cast("int")
    start = cut.select("doc_id", "text", "words", "g", a.alias("a"), n.alias("n"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    placed = start.select("doc_id", "text", "words", "a", "n", p.alias("p"))
    again = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


RUNS_SQL = f"""
WITH cut AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce({crc32('doc_id')}, 1) AS h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
given AS (SELECT row, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS i, h % 10 = 0 AS looped, (h // 10) % len(words) AS a,
    1 + (len(words) - (h // 10) % len(words)) // (3 + (h // 10) % 8) AS p FROM cut WHERE len(words) > 0),
told AS (SELECT g.row, g.n, g.i, o.word FROM given g JOIN given o ON o.row = g.row AND o.i = CASE WHEN g.looped AND g.i >= g.a THEN g.a + (g.i - g.a) % g.p ELSE g.i END),
triples AS (SELECT row, n, i, word AS x, lead(word, 1) OVER w AS y, lead(word, 2) OVER w AS z FROM told WINDOW w AS (PARTITION BY row ORDER BY i)),
same AS (SELECT a.row, a.i, b.i - a.i AS q FROM triples a JOIN triples b ON a.row = b.row AND a.x = b.x AND a.y = b.y AND a.z = b.z AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
islands AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM same),
long AS (SELECT row, min(i) AS start, max(i) + 3 + q - min(i) AS length, q AS period FROM islands GROUP BY row, q, island
  HAVING max(i) + 3 + q - min(i) >= greatest(6, 4 * q)),
runs AS (SELECT * FROM long r WHERE NOT EXISTS (
  SELECT 1 FROM long s WHERE s.row = r.row AND s.period < r.period AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM told ANTI JOIN gone USING (row, i) GROUP BY row),
listed AS (SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || CHR(10), '' ORDER BY start, period) AS lines,
  first(start ORDER BY length DESC, start, period) AS start, first(length ORDER BY length DESC, start, period) AS length,
  first(period ORDER BY length DESC, start, period) AS period FROM runs GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM cut LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)"""
