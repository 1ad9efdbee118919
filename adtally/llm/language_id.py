"""Language identification by rank-order profiles.

A language's profile is its most frequent n-grams in order of frequency. A document's own most
frequent n-grams are compared with each profile by the out-of-place distance: the sum, over the
document's n-grams, of how far the rank there is from the rank here, with ``top`` for an n-gram the
profile lacks. The language with the least distance is the prediction; its score is one less the
distance as a share of the largest possible one.

N-grams are one to three bytes of the UTF-8 text. Capitals A-Z and À-Þ are folded, all other ASCII
signs separate words, a word has one blank on either side, and an n-gram with a blank inside or of
a blank alone does not count. The same rule holds in training, in prediction and in ``language_sql``.

Profiles are learned from all training documents: tasks count n-grams per language, Spark sums the
counts, and the ``top`` most frequent of each language are collected (languages times ``top`` rows,
which does not grow with the corpus). Prediction reads every text once and shuffles nothing.

Texts are walked in windows of about a megabyte that end at a separator, and the counts of a text's windows
are added, so memory follows the window (about 40 bytes per byte of it, mostly keys to be sorted) and not
the text; only a single word longer than a window is taken whole.

Defined cases: a NULL text, an empty one and one without a Unicode letter are ``und`` with score 0, as is every
text when nothing was learned; a NULL language teaches nothing; a NULL id is not held out. Equal counts are ordered by
n-gram, equal distances by language. Repeated rows count as often as they occur; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm import words as W
from adtally.llm.sql import crc32

TOP = 400
WINDOW = 1 << 20
ROWS = 256  # documents looked at together: their number in a window takes eight bits of a key
UNKNOWN = "und"

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_LETTER = _ASCII_LETTER.copy()
_LETTER[128:] = True
_BLANK = np.uint8(32)


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and À-Þ (after a C3 byte, 80-9E but 97) in lower case."""
    out = W.LOWER[data]
    latin = np.flatnonzero(data == 0xC3) + 1
    latin = latin[latin < len(data)]
    low = data[latin]
    latin = latin[(low >= 0x80) & (low <= 0x9E) & (low != 0x97)]
    out[latin] += 0x20
    return out


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``document << 24 | n-gram`` of every n-gram of at most 256 texts, in no order."""
    starts, ends, first = W.spans(data, offsets, _LETTER)
    if not len(starts):
        return np.zeros(0, np.uint32)
    size = ends - starts
    inside = np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    word = np.repeat(np.arange(len(starts)), size)
    place = np.arange(len(inside)) + word + 1  # a blank before each word
    text = np.full(len(inside) + len(starts) + 3, _BLANK, np.uint8)
    text[place] = folded(data)[inside]
    owner = np.zeros(len(text), np.uint32)
    of_word = W.owners(first).astype(np.uint32) << np.uint32(24)
    owner[place] = of_word[word]
    n = len(text) - 2
    a, b, c = (text[k : k + n].astype(np.uint32) for k in range(3))
    letter = text != _BLANK
    one = letter[:n]
    two = one | letter[1 : n + 1]
    three = letter[1 : n + 1]  # the middle is a letter; the ends may be blanks
    ab = (a << np.uint32(8)) | b
    return np.concatenate([
        (owner[:n] | a)[one],
        (np.maximum(owner[:n], owner[1 : n + 1]) | ab)[two],
        (owner[1 : n + 1] | (ab << np.uint32(8)) | c)[three],
    ])


def _runs(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs (or the sum of its counts)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    if counts is None:
        return keys[at], np.diff(np.concatenate([at, [len(keys)]]))
    return keys[at], np.add.reduceat(counts, at)


def counted(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, rows, keys, counts`` for runs of whole rows; keys are ``row - first row << 24 | n-gram`` in order."""
    offsets, data = W.raw(batch.column(text))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + WINDOW, "right")) - 1)
        high = min(high, low + ROWS)
        own = data[offsets[low] : offsets[high]]
        if len(own) <= WINDOW:
            yield low, high - low, *_runs(grams(own, offsets[low : high + 1] - offsets[low]))
        else:  # one long text
            keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            for piece in W.windows(own, _LETTER, WINDOW):
                k, c = _runs(grams(piece, np.array([0, len(piece)])))
                keys, counts = _runs(np.concatenate([keys, k]), np.concatenate([counts, c]))
            yield low, 1, keys, counts
        low = high


def ranked(keys: np.ndarray, counts: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, rank, n-gram`` of the ``top`` most frequent n-grams of each row, ranks from 0."""
    row = (keys >> np.uint32(24)).astype(np.uint64)
    gram = (keys & np.uint32(0xFFFFFF)).astype(np.uint64)
    rare = (np.uint64((1 << 32) - 1) - counts.astype(np.uint64)) << np.uint64(24)  # a count is below 2^32
    order = np.sort((row << np.uint64(56)) | rare | gram)
    row = (order >> np.uint64(56)).astype(np.int64)
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < top
    return row[keep], rank[keep], (order[keep] & np.uint64(0xFFFFFF)).astype(np.int64)


@dataclass
class Profiles:
    """Languages in order of their names, and the rank of every n-gram in each (``top`` where it has none)."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    top: int

    @classmethod
    def of(cls, rows, top: int) -> Profiles:
        """From ``lang, gram, rank`` rows."""
        languages = sorted({r.lang for r in rows})
        known = np.array(sorted({r.gram for r in rows}), np.int64)
        ranks = np.full((len(known) + 1, len(languages)), top, np.int64)
        at = {g: k for k, g in enumerate(known.tolist())}
        for r in rows:
            ranks[at[r.gram], languages.index(r.lang)] = r.rank
        return cls(languages, known, ranks, top)

    def distances(self, rows: int, row: np.ndarray, rank: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place distance of each row to each language, and its largest possible value."""
        at = np.searchsorted(self.grams, gram)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != gram)] = len(self.grams)
        theirs = self.ranks[at]
        away = np.where(theirs == self.top, self.top, np.abs(theirs - rank[:, None]))
        total = np.zeros((rows, len(self.languages)), np.int64)
        ends = np.searchsorted(row, np.arange(rows + 1))
        sums = np.concatenate([np.zeros((1, total.shape[1]), np.int64), np.cumsum(away, axis=0)])
        total[:] = sums[ends[1:]] - sums[ends[:-1]]
        return total, np.diff(ends) * self.top


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``text, lang`` with a language; tasks add up what they read first."""

    def run(batches):
        keys, counts, names = np.zeros(0, np.int64), np.zeros(0, np.int64), {}
        for batch in batches:
            codes = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.int64)
            for low, _, k, c in counted(batch):
                k = (codes[low + (k >> np.uint32(24)).astype(np.int64)] << 24) | (k & np.uint32(0xFFFFFF)).astype(np.int64)
                k, c = _runs(k, c)
                keys, counts = _runs(np.concatenate([keys, k]), np.concatenate([counts, c]))
        words = np.array(list(names), object)
        for part in range(0, len(keys), 1 << 16):
            k = keys[part : part + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[k >> 24], pa.string()), pa.array((k & 0xFFFFFF).astype(np.int32)), pa.array(counts[part : part + (1 << 16)])], ["lang", "gram", "n"]
            )

    taught = docs.select("lang", "text").where("lang is not null and text is not null")
    return taught.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, top: int = TOP) -> Profiles:
    """Profiles of the languages of ``text, lang`` rows. A group of the window is one language's distinct n-grams (below 2^24),
    of which every task sends ``top`` at most."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = gram_counts(docs).withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top)
    return Profiles.of(best.select("lang", "gram", "rank").collect(), top)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score, distance`` for every row of ``doc_id, text``."""
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        know = model.value
        names = np.array([*know.languages, UNKNOWN], object)
        for batch in batches:
            n, text = batch.num_rows, batch.column("text")
            best, away, most = np.full(n, len(know.languages)), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for low, rows, keys, counts in counted(batch) if know.languages else ():
                distance, full = know.distances(rows, *ranked(keys, counts, know.top))
                part = slice(low, low + rows)
                best[part], away[part], most[part] = distance.argmin(axis=1), distance.min(axis=1), full
            # texts without an ASCII letter may have no letter at all
            for k in np.flatnonzero(~_has_ascii_letter(text)):
                if not any(x.isalpha() for x in text[k].as_py() or ""):
                    best[k], away[k], most[k] = len(know.languages), 0, 0
            score = np.where(most > 0, 1 - away / np.maximum(most, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(away)], ["doc_id", "lang_pred", "score", "distance"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, distance long")


def _has_ascii_letter(column: pa.Array) -> np.ndarray:
    offsets, data = W.raw(column)
    out = np.zeros(len(offsets) - 1, bool)
    for low in range(0, len(out), 4096):  # bounded by the batch
        high = min(low + 4096, len(out))
        at = offsets[low] + np.flatnonzero(_ASCII_LETTER[data[offsets[low] : offsets[high]]])
        ends = np.searchsorted(at, offsets[low : high + 1])
        out[low:high] = ends[1:] > ends[:-1]
    return out


def identified(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Learn from the documents that are not held out, then predict all: ``doc_id, held_out, lang_pred, score``."""
    profiles = learn(docs.where(~held_out(F.col("doc_id"))), top)
    return identify(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"


def language_sql(top: int = TOP) -> str:
    return f"""
WITH held AS (
  SELECT doc_id, text, lang, row_number() OVER () AS row, regexp_matches(coalesce(text, ''), '\\p{{L}}') AS lettered, coalesce({crc32('doc_id')} % 5 = 0, false) AS held_out,
    hex(encode(' ' || trim(regexp_replace(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+', ' ', 'g')) || ' ')) AS h
  FROM documents),
bytes AS (SELECT row, unnest(cut) AS a, unnest(range(len(cut))) AS i FROM (SELECT row, regexp_extract_all(h, '..') AS cut FROM held WHERE h <> '2020')),
next AS (SELECT row, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM bytes WINDOW w AS (PARTITION BY row ORDER BY i)),
grams AS (SELECT row, unnest([a, a || b, a || b || c]) AS gram FROM next),
counts AS (SELECT row, gram, count(*) AS n FROM grams
  WHERE gram IS NOT NULL AND CASE length(gram) WHEN 2 THEN gram <> '20' WHEN 4 THEN gram <> '2020' ELSE substr(gram, 3, 2) <> '20' END GROUP BY row, gram),
own AS (SELECT row, gram, row_number() OVER (PARTITION BY row ORDER BY n DESC, length(gram), gram) - 1 AS rank FROM counts QUALIFY rank < {top}),
profile AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, length(gram), gram) - 1 AS rank
  FROM counts JOIN held USING (row) WHERE lang IS NOT NULL AND NOT held_out GROUP BY lang, gram QUALIFY rank < {top}),
away AS (SELECT own.row, l.lang, sum(CASE WHEN p.rank IS NULL THEN {top} ELSE abs(p.rank - own.rank) END) AS d, {top} * count(*) AS most
  FROM own CROSS JOIN (SELECT DISTINCT lang FROM profile) l LEFT JOIN profile p ON p.lang = l.lang AND p.gram = own.gram GROUP BY own.row, l.lang),
best AS (SELECT row, lang, d, most FROM away QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, lang) = 1)
SELECT doc_id, held_out, CASE WHEN lettered AND best.lang IS NOT NULL THEN best.lang ELSE 'und' END AS lang_pred,
  CASE WHEN lettered AND best.lang IS NOT NULL THEN 1 - CAST(d AS DOUBLE) / CAST(most AS DOUBLE) ELSE 0.0::DOUBLE END AS score
FROM held LEFT JOIN best USING (row)"""
