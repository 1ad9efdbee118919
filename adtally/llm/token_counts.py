"""Token counts that follow edits: a tree of segment counts per document, updated where edits fall.

A document is cut into segments of about ``SEGMENT`` characters, each starting at white space.
The tokenizer drops white space and never looks across it, so counts of segments add up to the
document's count. ``build`` encodes every segment once and stores the counts as leaves and their
sums, ``FAN`` to a node, level by level up to one root per document.

``apply_edits`` re-encodes only what edits touch. An edit replaces ``length`` characters from
``start`` by ``replacement``; all edits of a document refer to its text before any of them. An
edit touches the segments it reaches or borders on. If it takes away the white space a segment
starts with, the segment is encoded together with the one before; otherwise each touched segment is
encoded alone. Changes of leaves are added up along the path to the root.

Edits are routed to segments through cells of fixed length, so many edits of one document spread
over its segments. Texts of edited documents travel compressed, once; each is followed by its touched segments in
order, and they pass by as a stream: a task holds one text and one run of joined segments at a time. Other
texts stay where they are: documents are looked up in a bit table of edited ones, of 8 MB at most, which lets a few others through.
Leaves and nodes of an earlier run may be passed in, so that only edited documents are encoded at all.

Defined cases: a NULL text is empty; ``start`` and ``length`` are clipped to the text, NULL
values and edits of unknown documents change nothing, a NULL replacement deletes; of overlapping
edits the one that starts first, then has the least (stop, edit_id, replacement), holds and the others are
skipped; equal rows count once; rows of one id with different texts are documents of their own, each
with the id's edits; rows with a NULL id have no edits.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm import words as W
from adtally.llm.common import Stages
from adtally.llm.tokens import WordTokenizer

SEGMENT = 1024
FAN = 16
_GAP = re.compile("[ \t\n\r]")
KEY = ["doc_id", "copy"]
MARKS = 1 << 26  # bits of the table of edited documents, 2,048 bitmaps of 4 KB


def cut(text: str, size: int = SEGMENT) -> list[int]:
    """Starts of the segments: 0, and the first white space at least ``size`` characters after the last start."""
    starts = [0]
    while (gap := _GAP.search(text, starts[-1] + size)) is not None:
        starts.append(gap.start())
    return starts


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))


def segments(docs: DataFrame, tokenizer: str, size: int = SEGMENT) -> DataFrame:
    """Segments of ``doc_id, text`` with their places and token counts."""

    def run(batches):
        tokens = WordTokenizer.of(tokenizer)
        for batch in (part for whole in batches for part in W.slices(whole)):
            row, seg, start, body = [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                starts = cut(text, size)
                row += [k] * len(starts)
                seg += range(len(starts))
                start += starts
                body += [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]
            row, counts = pa.array(row, pa.int64()), tokens.counts(pa.array(body, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("copy").take(row), pa.array(seg, pa.int64()), pa.array(start, pa.int64()),
                 pa.array([len(x) for x in body], pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "copy", "seg", "start", "length", "n_tokens"],
            )

    return _keyed(docs).mapInArrow(run, "doc_id long, copy long, seg long, start long, length long, n_tokens long")


def edited_texts(docs: DataFrame, touched: DataFrame) -> DataFrame:
    """``doc_id, copy, text`` of the documents with touched segments, and of few others whose bit they share; no text is shuffled.

    The table is broadcast whatever the number of edits, as it has ``MARKS`` bits at most.
    """
    mark = F.pmod(F.xxhash64(*KEY), F.lit(MARKS)) + 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("bits")
    table = touched.select(mark.alias("mark")).groupBy(F.bitmap_bucket_number("mark").alias("block")).agg(bits)
    marked = _keyed(docs).withColumn("mark", mark)
    place = F.bitmap_bit_position("mark")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = marked.join(F.broadcast(table), F.bitmap_bucket_number("mark") == F.col("block"))
    return met.where(F.getbit(byte, (place % 8).cast("int")) == 1).select(*KEY, "text")


def packed_texts(texts: DataFrame) -> DataFrame:
    """``doc_id, copy, body`` of ``doc_id, copy, text``: the texts, compressed for the way to their edits."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in W.slices(whole)):
            body = [press.compress(text.encode()) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copy"), pa.array(body, pa.binary())], ["doc_id", "copy", "body"])

    return texts.mapInArrow(run, "doc_id long, copy long, body binary")


def build(docs: DataFrame, tokenizer: str, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """(leaves, nodes): segment counts, and their sums for every level from 0 to the common root level."""
    leaves = stages.write(segments(docs, tokenizer).dropDuplicates([*KEY, "seg"]), "leaves")
    level = leaves.select(*KEY, F.lit(0).alias("level"), F.col("seg").alias("node"), "n_tokens")
    nodes = level
    for k in range(1, levels(leaves)):
        level = (
            level.groupBy(*KEY, F.floor(F.col("node") / FAN).cast("long").alias("up")).agg(F.sum("n_tokens").alias("n_tokens"))
            .select(*KEY, F.lit(k).alias("level"), F.col("up").alias("node"), "n_tokens")
        )
        nodes = nodes.union(level)
    return leaves, stages.write(nodes, "nodes")


def levels(leaves: DataFrame) -> int:
    last, n = leaves.agg(F.max("seg")).first()[0] or 0, 1
    while last:
        last, n = last // FAN, n + 1
    return n


def _touched(edits: DataFrame, leaves: DataFrame) -> DataFrame:
    """Segments that edits reach or border on, with the edits that start there and whether the segment's first character goes."""
    sizes = leaves.groupBy(*KEY).agg(F.sum("length").alias("n_chars"))
    given = edits.where("doc_id is not null and start is not null and length is not null").select(
        F.col("doc_id").cast("long").alias("of"), F.col("edit_id").cast("string").alias("edit_id"),
        F.col("start").cast("long").alias("s"), F.greatest(F.col("length").cast("long"), F.lit(0)).alias("n"),
        F.coalesce("replacement", F.lit("")).alias("replacement"),
    )
    low = F.least(F.greatest("s", F.lit(0)), "n_chars")
    high = F.least(F.greatest(F.col("s"), F.lit(0)) + F.col("n"), F.col("n_chars"))
    clipped = given.join(sizes, F.col("of") == F.col("doc_id")).select(
        F.col("doc_id").alias("e_doc"), F.col("copy").alias("e_copy"), "edit_id", low.alias("low"), high.alias("high"), "replacement"
    )
    first = F.floor(F.col("low") / SEGMENT)
    reach = clipped.withColumn("first_cell", first).withColumn("e_cell", F.explode(F.sequence(first, F.floor(F.col("high") / SEGMENT))))
    stop = F.col("start") + F.col("length")
    spread = leaves.select(*KEY, "seg", "start", stop.alias("stop"), F.floor(F.col("start") / SEGMENT).alias("leaf_cell"))
    spread = spread.withColumn("cell", F.explode(F.sequence("leaf_cell", F.floor(F.col("stop") / SEGMENT))))
    met = spread.join(
        reach,
        (F.col("doc_id") == F.col("e_doc")) & (F.col("copy") == F.col("e_copy")) & (F.col("cell") == F.col("e_cell"))
        & (F.col("low") <= F.col("stop")) & (F.col("high") >= F.col("start")) & (F.col("cell") == F.greatest("leaf_cell", "first_cell")),
    )
    starts_here = (F.col("low") > F.col("start")) & (F.col("low") <= F.col("stop")) | (F.col("low") == 0) & (F.col("seg") == 0)
    edit = F.struct("low", "high", "edit_id", "replacement")
    broken = (F.col("low") <= F.col("start")) & (F.col("start") < F.col("high")) & (F.col("seg") > 0)
    return met.groupBy(*KEY, "seg").agg(F.collect_set(F.when(starts_here, edit)).alias("edits"), F.max(broken).alias("broken"))


class _Run:
    """Touched segments in a row that are encoded as one."""

    def __init__(self, row: dict):
        self.key, self.segs, self.start, self.texts, self.edits = (row["doc_id"], row["copy"]), [], row["start"], [], []

    def add(self, row: dict) -> None:
        self.segs.append(row["seg"])
        self.texts.append(row["text"])
        self.edits += row["edits"]

    def edited(self) -> tuple[str, int]:
        """(text after the edits, number of edits applied)"""
        text, out, at, applied = "".join(self.texts), [], self.start, 0
        free = self.start
        for low, high, _, replacement in sorted((e["low"], e["high"], e["edit_id"] or "", e["replacement"]) for e in self.edits):
            if low < free:
                continue
            out += [text[at - self.start : low - self.start], replacement]
            at = free = high
            applied += 1
        return "".join([*out, text[at - self.start :]]), applied


def _reencode(tokenizer: str):
    def run(batches):
        tokens, now, done = WordTokenizer.of(tokenizer), None, []
        text, starts = "", []  # of the document that was read last, whose touched segments follow

        def flushed():
            texts = pa.array([t for _, t, _ in done], pa.string())
            counts = tokens.counts(texts)
            rows = [
                (*r.key, seg, int(n) if not k else 0, applied if not k else 0, len(text) if not k else 0)
                for (r, text, applied), n in zip(done, counts, strict=True)
                for k, seg in enumerate(r.segs)
            ]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], _CHANGED.names)

        def close():
            if now is not None and now.edits:
                done.append((now, *now.edited()))

        for batch in batches:
            for row in batch.to_pylist():
                if row["edits"] is None:
                    text = zstandard.ZstdDecompressor().decompress(row["body"]).decode()
                    starts = [*cut(text), len(text)]
                    continue
                low, high = starts[row["seg"]], starts[row["seg"] + 1]
                row = {**row, "text": text[low:high], "start": low}
                joined = now is not None and row["broken"] and now.key == (row["doc_id"], row["copy"]) and now.segs[-1] == row["seg"] - 1
                if not joined:
                    close()
                    now = _Run(row)
                now.add(row)
            if done:
                yield flushed()
        close()
        if done:
            yield flushed()

    return run


_CHANGED = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "copy", "seg", "n_tokens", "applied", "chars")])


def apply_edits(docs: DataFrame, leaves: DataFrame, nodes: DataFrame, edits: DataFrame, tokenizer: str, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """(changed leaves, updated nodes). ``edits`` holds ``doc_id, edit_id, start, length, replacement``."""
    touched = stages.write(_touched(edits, leaves), "touched")
    kind = "array<struct<low: long, high: long, edit_id: string, replacement: string>>"
    both = packed_texts(edited_texts(docs, touched)).select(*KEY, F.lit(-1).cast("long").alias("seg"), "body", F.lit(None).cast(kind).alias("edits"), F.lit(False).alias("broken")).union(
        touched.select(*KEY, "seg", F.lit(None).cast("binary"), "edits", "broken")
    )
    merged = both.repartition(*KEY).sortWithinPartitions(*KEY, "seg")
    changed = stages.write(merged.mapInArrow(_reencode(tokenizer), _CHANGED), "changed")
    before = leaves.select(*KEY, "seg", F.col("n_tokens").alias("old"))
    delta = changed.join(before, [*KEY, "seg"]).select(*KEY, "seg", (F.col("n_tokens") - F.col("old")).alias("delta"))
    steps = F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels(leaves) - 1)), lambda k: F.struct(k.alias("level"), F.pow(F.lit(FAN), k).cast("long").alias("size"))))
    paths = delta.select(*KEY, "seg", "delta", steps.alias("step")).groupBy(
        *KEY, F.col("step.level").alias("level"), F.floor(F.col("seg") / F.col("step.size")).cast("long").alias("node")
    ).agg(F.sum("delta").alias("delta"))
    updated = nodes.join(paths, [*KEY, "level", "node"], "left")
    return changed, updated.select(*KEY, "level", "node", (F.col("n_tokens") + F.coalesce("delta", F.lit(0))).alias("n_tokens"))


def counted_with_edits(docs: DataFrame, edits: DataFrame, tokenizer: str, stored: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per document: tokens before and after its edits, and how much was encoded again.

    ``stored`` are leaves and nodes that ``build`` made of the same documents.
    """
    stages = Stages(docs.sparkSession, "tokens")
    leaves, nodes = stored or build(docs, tokenizer, stages)
    changed, updated = apply_edits(docs, leaves, nodes, edits, tokenizer, stages)
    top = levels(leaves) - 1
    after = updated.where(F.col("level") == top).select(F.col("doc_id").alias("d"), F.col("copy").alias("c"), F.col("n_tokens").alias("tokens_after"))
    sizes = leaves.groupBy(*KEY).agg(F.sum("n_tokens").alias("tokens_before"), F.sum("length").alias("chars"), F.count("*").alias("segments"))
    again = changed.groupBy(F.col("doc_id").alias("d2"), F.col("copy").alias("c2")).agg(
        F.sum("applied").alias("edits"), F.count("*").alias("segments_encoded"), F.sum("chars").alias("chars_encoded")
    )
    rows = sizes.join(after, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c"))).join(
        again, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("copy") == F.col("c2")), "left"
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("edits", "segments_encoded", "chars_encoded")]
    return rows.select("doc_id", "tokens_before", "tokens_after", "chars", "segments", *zero)
