"""Best-fit-decreasing packing of whole documents into sequences of fixed capacity.

Only lengths matter for packing, and there are at most ``capacity`` of them, so what best-fit
decreasing does with all pieces follows from the histogram of lengths: pieces of one length are
alike, and so are bins with the same room left. The plan is made on that histogram, longest
first, with a segment tree over the remaining capacities that finds the tightest open bin in
logarithmic time; bins are kept as ranges of numbers, so the plan's size does not depend on the
number of documents. The histogram is the only thing the driver sees. Texts are encoded in slices
of whole rows of about a megabyte.

Pieces get a rank within their length: their rank in the task that encoded them (kept with the
written pieces) plus the counts of earlier tasks. Rank and plan give bin and offset.

Defined cases: a NULL or empty text is one piece holding only the closing id; repeated
documents are packed each; ties among pieces of one length follow task and row order; an empty
table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm import words as W
from adtally.llm.common import Stages
from adtally.llm.tokens import WordTokenizer

SLICE = 1 << 20
PIECE = T.StructType(
    [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
     T.StructField("ids_crc32", T.LongType()), T.StructField("task", T.IntegerType()), T.StructField("rank", T.LongType())]
)


IDS = T.StructField("ids", T.ArrayType(T.LongType()))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Documents as runs of at most ``capacity`` ids, the closing id included; only longer documents are cut."""
    docs = docs.select("doc_id", "text")

    def cut(batches):
        tokens = WordTokenizer.of(tokenizer)
        task, seen, end = TaskContext.get().partitionId(), defaultdict(int), np.array([end_id], np.uint32)
        for batch in (part for whole in batches for part in W.slices(whole, limit=SLICE)):
            rows, runs = [], []
            for k, ids in enumerate(tokens.ids(batch.column("text"))):
                ids = np.concatenate([ids, end])
                for number, low in enumerate(range(0, len(ids), capacity)):
                    part = ids[low : low + capacity]
                    rows.append((k, number, low, len(part), zlib.crc32(part.astype("<u4", copy=False)), seen[len(part)]))
                    seen[len(part)] += 1
                    runs.append(part)
            row, number, start, length, crc, rank = np.array(rows, np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start), pa.array(length),
                 pa.array(crc), pa.array(np.full(len(row), task), pa.int32()), pa.array(rank),
                 *([pa.array([r.astype(np.int64) for r in runs], pa.list_(pa.int64()))] if with_ids else [])],
                schema.names,
            )

    schema = T.StructType([docs.schema["doc_id"], *PIECE.fields, *([IDS] if with_ids else [])])
    return docs.mapInArrow(cut, schema)


class Tightest:
    """Segment tree over remaining capacities: the smallest open one that is at least ``need``."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.size)

    def set(self, room: int, is_open: bool) -> None:
        at = self.size + room
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def find(self, need: int) -> int | None:
        at = self.size + need
        if self.open[at]:
            return need
        while at > 1:
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, first bin, pieces per bin, offset of the first piece), by length and rank.

    The same bins as placing every piece, longest first, into the tightest bin with room.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> ranges of bins (first, number)
    tree, plan, bins = Tightest(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.find(length)
            if room is None:
                # new bins: each is filled with this length before the next is opened, as it is then the tightest
                first, number, room = bins, -(-left // (capacity // length)), capacity
                bins += number
            else:
                first, number = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            per = room // length
            full = min(number, left // per)
            used = full
            if full:
                plan.append((length, rank, first, per, capacity - room))
                rank, left = rank + full * per, left - full * per
                _give_back(rooms, tree, room - per * length, first, full)
            if left and used < number:
                plan.append((length, rank, first + used, left, capacity - room))
                _give_back(rooms, tree, room - left * length, first + used, 1)
                rank, left, used = rank + left, 0, used + 1
            if used < number:
                _give_back(rooms, tree, room, first + used, number - used)
    return plan


def _give_back(rooms, tree, room: int, first: int, number: int) -> None:
    if room:
        rooms[room].append((first, number))
        tree.set(room, True)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and its place there, and with its ids on request.

    ``docs`` holds ``doc_id, text``; ``tokenizer`` is the path of a ``word_bpe`` file on the executors.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "pack")
    cut = stages.write(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    counts = stages.write(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    # at most `capacity` rows
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit_plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    # the counts grow with the number of tasks, so they are shuffled, whatever their compressed size suggests
    ranked = cut.join(before.hint("merge"), ["length", "task"]).select(
        *kept, (F.col("rank") + F.col("before")).alias("rank")
    )

    def place(batches):
        rows = plan.value
        keys = [(r[0], r[1]) for r in rows]
        order = sorted(range(len(rows)), key=keys.__getitem__)
        lengths = np.array([rows[i][0] for i in order], np.int64)
        table = np.array([rows[i] for i in order], np.int64).reshape(-1, 5)
        begin = {int(n): int(i) for n, i in zip(*np.unique(lengths, return_index=True), strict=True)}
        stop = {n: i for n, i in zip(begin, [*list(begin.values())[1:], len(rows)], strict=True)}
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                firsts = table[begin[int(n)] : stop[int(n)], 1]
                at[own] = begin[int(n)] + np.searchsorted(firsts, rank[own], "right") - 1
            _, first_rank, first_bin, per, offset = table[at].T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(first_bin + (rank - first_rank) // per), pa.array(offset + (rank - first_rank) % per * length)],
                [*kept, "sequence_id", "offset"],
            )

    schema = T.StructType([*ranked.select(*kept).schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)
