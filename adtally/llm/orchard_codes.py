"""Product codes of vectors, with the nearest codebook entry found by Orchard's search.

A vector's components become integers ``floor(scale * x)`` and are cut into equal consecutive parts. Each
part position has a codebook of at most 256 entries, which starts as that part of the vectors with the
smallest ids. A round assigns every part to its nearest entry and replaces each entry by the componentwise
``floor(sum / count)`` of its parts; entries nobody chose stay. At last all parts are assigned again. A
code is one byte per part, the error the sum of the squared distances.

Orchard's search: every entry has a list of all entries sorted by their distance from it. A part starts at some entry and
walks that entry's list; entries already looked at are marked and passed over; when a nearer entry turns up, the walk goes on in
that entry's list; it ends where the list is farther away than twice the present distance, since by the triangle inequality nothing
beyond can be nearer. Distances are whole numbers, so ends and ties (lower index) are exact. Here all parts of a batch walk
together, ``STRIDE`` places of their lists at a time, each starting where the part before it in the table ended.

Every round is one pass over the vectors, which were written once as integers: tasks add up sums per entry, Spark adds the
tasks' rows with its own partial sums, and the driver receives one row per entry. Nothing else is collected.

Defined cases: vectors that are NULL or hold a NULL, NaN or infinite component are dropped; others of different widths are coded apart,
each width with its own codebooks, drawn from its own smallest ids; where a width is no multiple of ``parts``, the first parts are one longer,
and parts of an empty vector have distance 0. With fewer vectors than entries the codebook is that short. Vectors of one id are ordered by
their components, NULL ids come last. NULL labels are one group. Components beyond ``2^24 / scale`` are refused, as distances would not be exact.
Extra columns, whatever their names, are ignored. Without vectors there are no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm.common import Stages
from adtally.operators.joins import attach_total

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
STRIDE, BATCH = 16, 2048
LARGEST = 1 << 24


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, q``: vectors as integers, without the unusable ones."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def step(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) <= LARGEST, F.floor(y).cast("int")).otherwise(F.raise_error(F.lit("a component is too large to be coded")))

    return vectors.where("embedding is not null").where(F.coalesce(good, F.lit(False))).select("vec_id", "label", F.transform("embedding", step).alias("q"))


def cuts(width: int, parts: int) -> list[slice]:
    ends = np.cumsum([0] + [len(x) for x in np.array_split(np.arange(width), parts)])
    return [slice(int(a), int(b)) for a, b in zip(ends[:-1], ends[1:], strict=True)]


@dataclass
class Codebook:
    """Entries of one part position with each entry's list of all entries, nearest first."""

    entries: np.ndarray
    lists: np.ndarray
    reach: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebook:
        away = np.zeros((len(entries), len(entries)), np.int64)
        for k, e in enumerate(entries):
            away[k] = ((entries - e) ** 2).sum(axis=1)
        lists = np.argsort(away, axis=1, kind="stable")
        return cls(entries, lists, np.take_along_axis(away, lists, axis=1))

    def nearest(self, x: np.ndarray, begin: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry for each row, ties to the lower index, and the squared distance."""
        n, k = len(x), len(self.entries)
        best = np.full(n, begin, np.int64)
        least = ((x - self.entries[begin]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[:, begin] = True
        place = np.zeros(n, np.int64)  # in the list of the best entry
        walking = np.arange(n)
        ahead = np.arange(STRIDE)
        while len(walking):
            at = place[walking, None] + ahead
            inside = np.minimum(at, k - 1)
            here = best[walking, None]
            entry = self.lists[here, inside]
            # squared distances, so twice the distance is four times the number
            open_ = (at < k) & (self.reach[here, inside] <= 4 * least[walking, None])
            new = open_ & ~seen[walking[:, None], entry]
            row, col = np.nonzero(new)
            distance = np.full(new.shape, np.iinfo(np.int64).max)
            distance[row, col] = ((x[walking[row]] - self.entries[entry[row, col]]) ** 2).sum(axis=1)
            seen[walking[row], entry[row, col]] = True
            nearest = distance.min(axis=1)
            index = np.where(distance == nearest[:, None], entry, k).min(axis=1)
            better = (nearest < least[walking]) | ((nearest == least[walking]) & (index < best[walking]))
            jump = walking[better]
            best[jump], least[jump], place[jump] = index[better], nearest[better], 0
            place[walking[~better]] += STRIDE
            walking = walking[better | open_.all(axis=1)]
        return best, least


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), width)


@dataclass
class Coder:
    """The codebooks of one width of vectors."""

    width: int
    books: list[Codebook]

    @classmethod
    def of(cls, width: int, entries: list[np.ndarray]) -> Coder:
        return cls(width, [Codebook.of(e) for e in entries])

    def assigned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (a column per part) and the squared distances of each part."""
        code, error = np.empty((len(x), len(self.books)), np.int64), np.empty((len(x), len(self.books)), np.int64)
        for part, (own, book) in enumerate(zip(cuts(self.width, len(self.books)), self.books, strict=True)):
            begin = 0
            for low in range(0, len(x), BATCH):
                high = min(low + BATCH, len(x))
                code[low:high, part], error[low:high, part] = book.nearest(x[low:high, own], begin)
                begin = int(code[high - 1, part])
        return code, error

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.books for v in book.entries.ravel().tolist()).encode()).hexdigest()


def first_entries(vectors: DataFrame, width: int, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the ``entries`` vectors with the smallest ids."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).select("q").collect()
    table = np.array([r.q for r in rows], np.int64).reshape(len(rows), width)
    return [table[:, own].copy() for own in cuts(width, parts)]


def improved(vectors: DataFrame, coder: Coder) -> list[np.ndarray]:
    """Entries moved to the floor of the mean of their parts."""
    shared = vectors.sparkSession.sparkContext.broadcast(coder)
    own, longest = cuts(coder.width, len(coder.books)), -(-coder.width // len(coder.books))

    def run(batches):
        know = shared.value
        sums = [np.zeros_like(book.entries) for book in know.books]
        counts = [np.zeros(len(book.entries), np.int64) for book in know.books]
        for batch in batches:
            x = _vectors(batch.column("q"), know.width)
            code, _ = know.assigned(x)
            for part, cut in enumerate(own):
                np.add.at(sums[part], code[:, part], x[:, cut])
                counts[part] += np.bincount(code[:, part], minlength=len(counts[part]))
        for part, n in enumerate(counts):
            used = np.flatnonzero(n)
            wide = np.zeros((len(used), longest), np.int64)
            wide[:, : sums[part].shape[1]] = sums[part][used]
            columns = [np.full(len(used), part, np.int32), used.astype(np.int32), n[used], *wide.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["part", "entry", "n", *[f"s{k}" for k in range(longest)]])

    total = ["n", *[f"s{k}" for k in range(longest)]]
    schema = ", ".join(["part int", "entry int", *[f"{c} long" for c in total]])
    rows = vectors.select("q").mapInArrow(run, schema).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in total]).collect()
    shared.destroy()
    out = [book.entries.copy() for book in coder.books]
    for row in rows:  # parts times entries
        part = out[row["part"]]
        part[row["entry"]] = np.array(row[3 : 3 + part.shape[1]], np.int64) // row["n"]
    return out


def fit(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Coder:
    """Codebooks for ``vec_id, q`` rows of one width; the table is read ``rounds`` times, so pass a written one."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    coder = Coder.of(width, first_entries(vectors, width, parts, entries))
    for _ in range(rounds):
        coder = Coder.of(width, improved(vectors, coder))
    return coder


def encode(vectors: DataFrame, coder: Coder) -> DataFrame:
    """``vec_id, label, code, error`` with the code as lower-case hex, one byte per part."""
    shared = vectors.sparkSession.sparkContext.broadcast(coder)

    def run(batches):
        for batch in batches:
            code, error = shared.value.assigned(_vectors(batch.column("q"), shared.value.width))
            text = [row.tobytes().hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error.sum(axis=1))], ["vec_id", "label", "code", "error"]
            )

    fields = [vectors.schema["vec_id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return vectors.select("vec_id", "label", "q").mapInArrow(run, T.StructType(fields))


def decoded(codes: DataFrame, coder: Coder, scale: int = SCALE) -> DataFrame:
    """``vec_id, approximation``: the vectors that the codes stand for, each component at the middle of its step."""
    books = F.array(*[F.lit([[(v + 0.5) / scale for v in e] for e in book.entries.tolist()]) for book in coder.books])
    byte = F.transform(F.sequence(F.lit(0), F.lit(len(coder.books) - 1)), lambda k: F.conv(F.substring("code", 2 * k + 1, F.lit(2)), 16, 10).cast("int"))
    return codes.select("vec_id", F.flatten(F.transform(byte, lambda c, k: F.get(F.get(books, k), c))).alias("approximation"))


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every usable row of ``vec_id, embedding, label``."""
    stages = Stages(vectors.sparkSession, "orchard")
    whole = stages.write(usable(vectors, scale), "integers")
    coded = None
    # a table holds vectors of one width, or of few
    for width in sorted(r.width for r in whole.select(F.size("q").alias("width")).distinct().collect()):
        own = whole.where(F.size("q") == width)
        coder = fit(own, width, parts, entries, rounds)
        part = stages.write(encode(own, coder).withColumn("codebooks_sha256", F.lit(coder.digest())), f"codes-{width}")
        coded = part if coded is None else coded.unionAll(part)
    if coded is None:
        coded = encode(whole, Coder.of(0, [np.zeros((0, 0), np.int64)] * parts)).withColumn("codebooks_sha256", F.lit(""))
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return attach_total(coded, labels, ["label"]).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _round_sql(k: int) -> str:
    """Round ``k`` in SQL: nearest entries by the inner product, then floored means."""
    distance = "xx - 2 * list_inner_product(x, e) + list_inner_product(e, e)"
    return f"""near{k} AS MATERIALIZED (SELECT row, p, min(CAST({distance} AS BIGINT) * 256 + entry) AS best FROM parts JOIN book{k} USING (p) GROUP BY row, p),
mean{k} AS (SELECT p, entry, list(m ORDER BY pos) AS e FROM (
  SELECT p, best % 256 AS entry, pos, floor(sum(v) / count(*)) AS m
  FROM (SELECT row, p, unnest(x) AS v, unnest(range(len(x))) AS pos FROM parts) JOIN near{k} USING (row, p) GROUP BY ALL) GROUP BY p, entry),
book{k + 1} AS MATERIALIZED (SELECT p, entry, coalesce(m.e, b.e) AS e FROM book{k} b LEFT JOIN mean{k} m USING (p, entry))"""


ORCHARD_SQL = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT row, p, x, list_inner_product(x, x) AS xx FROM (
  SELECT row, p, q[1 + p * len(q) // 4 : (p + 1) * len(q) // 4] AS x FROM kept, range(4) t(p))),
book0 AS (SELECT p, entry, x AS e FROM parts JOIN (SELECT row, row_number() OVER (ORDER BY vec_id, q) - 1 AS entry FROM kept QUALIFY entry < 256) USING (row)),
{", ".join(_round_sql(k) for k in range(5))},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error
  FROM near4 JOIN kept USING (row) GROUP BY row, vec_id, label),
book AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, pos)) AS codebooks_sha256
  FROM (SELECT p, entry, unnest(e) AS v, unnest(range(len(e))) AS pos FROM book4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, book"""
