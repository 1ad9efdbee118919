"""Quality classifier learned from trusted positives and unlabelled web text.

Features are shape statistics of a whole text (letter, sign and line mix, word lengths,
repetition); no label, language, source or id enters them. A small network is trained on the
driver to minimise the non-negative unbiased risk: with class prior ``p`` the risk is
``p * loss(positives as +1) + max(0, loss(unlabelled as -1) - p * loss(positives as -1))``, and
where the second term falls below zero the step undoes it instead.

Training uses a bounded sample: about ``max_positive`` trusted positives and ``max_unlabelled``
other texts, chosen by a hash of the id over the whole table. The prior is the share of
positives among the trusted rows when those hold both classes; otherwise it is estimated
from the scores of a first model, as the least ratio of unlabelled to positive tail shares.
Scoring reads every text once and shuffles nothing.

Texts are looked at in slices of whole rows of about a megabyte, a longer one in windows; a task needs about 25 bytes for each
byte of a slice, and 16 for each distinct word of a longer text.

Defined cases: a NULL text scores as an empty one; an id that is NULL is not held out; a
document marked both good and bad is not a trusted positive; repeated documents score alike;
without any trusted positive every score is the prior, 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm import words as W

FEATURES = 24
WINDOW = 1 << 20
_UPPER, _LOWER, _DIGIT, _SPACE, _BREAK, _HIGH, _STOP, _BAR, _MARK, _SIGN = range(10)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = _SPACE, _BREAK
_CLASS[[44, 46]], _CLASS[[124]], _CLASS[[33, 63]] = _STOP, _BAR, _MARK


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[first])


def _distinct(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _sums(offsets: np.ndarray, data: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Additive counts of each text, and its words' hashes with the text of each.

    ``before`` holds the hashes of up to two words that precede a window of one text.
    """
    kind = _CLASS[data]
    starts, ends, first = W.spans(data, offsets, W.SPACED)
    running = np.zeros(len(data) + 1, np.int32)

    def count(mask: np.ndarray) -> np.ndarray:
        np.cumsum(mask, out=running[1:], dtype=np.int32)
        return running

    mix = [np.diff(count(kind == k)[offsets]) for k in range(10)]

    def inside(mask: np.ndarray) -> np.ndarray:
        total = count(mask)
        return total[ends] - total[starts]

    length = ends - starts
    signs = inside((kind == _SIGN) | (kind == _MARK) | (kind == _BAR))
    capitals = inside(kind == _UPPER)
    small = inside((kind == _LOWER) | (kind == _HIGH))
    owner = W.owners(first)
    h = np.concatenate([before, W.hash_words(data, starts, ends)])
    of = np.concatenate([np.zeros(len(before), np.int64), owner])

    def again(back: int) -> np.ndarray:
        same = np.zeros(len(h), bool)
        same[back:] = (h[back:] == h[:-back]) & (of[back:] == of[:-back])
        return same[len(before) :]

    per_word = [length, length**2, signs >= 2, signs >= 1, (capitals >= 2) & (small == 0), again(1), again(2)]
    return np.stack([*mix, np.diff(first), *(_per_text(v, first) for v in per_word)], axis=1), h[len(before) :], owner


def _row(sums: np.ndarray, size: np.ndarray, distinct: np.ndarray, most: np.ndarray) -> np.ndarray:
    mix, n_words = sums[:, :10].astype(float), sums[:, 10]
    total, squares, signs2, signs1, shouted, again, again2 = sums[:, 11:].T.astype(float)
    words, lines, chars = np.maximum(n_words, 1), mix[:, _BREAK] + 1, np.maximum(size, 1)
    mean = total / words
    spread = np.sqrt(np.maximum(squares / words - mean**2, 0))
    log = np.log1p
    out = np.stack([
        log(size), log(n_words), mean, spread, log(chars / lines), log(words / lines),
        *(np.sqrt(mix[:, k] / chars) for k in range(10)),
        np.sqrt(signs2 / words), np.sqrt(signs1 / words), np.sqrt(shouted / words), np.sqrt(again / words), np.sqrt(again2 / words),
        distinct / words, np.sqrt(most / words), log(words) - log(distinct),
    ], axis=1)
    out[n_words == 0, 2:] = 0
    return out


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text. A text longer than a window is walked in windows that end at white
    space, whose counts are added."""
    offsets, data = W.raw(column)
    n, nothing = len(offsets) - 1, np.zeros(0, np.uint64)
    if n == 1 and len(data) > WINDOW:
        sums, keys, counts, before = 0, nothing, np.zeros(0, np.int64), nothing
        for piece in W.windows(data, W.SPACED, WINDOW):
            own, h, _ = _sums(np.array([0, len(piece)]), piece, before)
            sums = sums + own
            keys, counts = _distinct(np.concatenate([keys, h]), np.concatenate([counts, np.ones(len(h), np.int64)]))
            before = np.concatenate([before, h])[-2:]
        return _row(sums, np.array([len(data)]), np.array([len(keys)]), np.array([counts.max(initial=0)], float))
    sums, h, owner = _sums(offsets, data, nothing)
    keyed = W.mixed(h ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, where, times = np.unique(keyed, return_index=True, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, owner[where], times)
    return _row(sums, np.diff(offsets), np.bincount(owner[where], minlength=n), most)


@dataclass
class Network:
    """Standardised features, one hidden layer."""

    centre: np.ndarray
    scale: np.ndarray
    prior: float
    weights: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(self.standard(x) @ a + b) @ c + d[0]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 24, epochs: int = 40, seed: int = 7) -> Network:
    """Minimise the non-negative unbiased risk with logistic loss."""
    if not len(positive) or not len(unlabelled):
        d = np.zeros(1)
        return Network(np.zeros(FEATURES), np.ones(FEATURES), 0.5, [np.zeros((FEATURES, hidden)), np.zeros(hidden), np.zeros(hidden), d])
    rng = np.random.default_rng(seed)
    centre, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    net = Network(centre, np.where(scale > 1e-9, scale, 1), prior, [])
    net.weights = [
        rng.normal(0, FEATURES**-0.5, (FEATURES, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden),
        np.array([np.log(prior / (1 - prior))]),
    ]
    p, u = net.standard(positive), net.standard(unlabelled)
    moment = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights]
    batches = max(4, -(-max(len(p), len(u)) // 1024))
    step = 0
    for epoch in range(epochs):
        rate = 5e-3 * (1 - epoch / epochs) + 1e-4
        for own_p, own_u in zip(
            np.array_split(rng.permutation(len(p)), batches), np.array_split(rng.permutation(len(u)), batches), strict=True
        ):
            if not len(own_p) or not len(own_u):
                continue
            x = np.concatenate([p[own_p], u[own_u]])
            a, b, c, d = net.weights
            inner = np.tanh(x @ a + b)
            z = inner @ c + d[0]
            zp, zu = z[: len(own_p)], z[len(own_p) :]
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            as_negative = np.concatenate([-prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)])
            if negative >= 0:
                slope = as_negative
                slope[: len(zp)] -= prior * _sigmoid(-zp) / len(zp)
            else:
                slope = -as_negative
            back = np.outer(slope, c) * (1 - inner**2)
            grads = [x.T @ back, back.sum(axis=0), inner.T @ slope, np.array([slope.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                grad = grad + 1e-5 * net.weights[k] * (k != 3)
                m, v = moment[k]
                m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
                moment[k] = (m, v)
                net.weights[k] = net.weights[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def tail_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Class prior from scores: positives are a part of the unlabelled, so no tail may hold a smaller share of the latter."""
    cuts = np.quantile(positive, np.linspace(0.05, 0.9, 18))
    ratio = [(unlabelled >= c).mean() / max((positive >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(min(ratio), 0.05, 0.95))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def _chosen(doc_id: Column, share: float, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 12_000, max_unlabelled: int = 12_000) -> Network:
    """``docs`` holds ``doc_id, text``, ``labels`` holds ``doc_id, quality``; held-out rows are not looked at."""
    trusted = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")
    )
    n_good, n_bad = trusted.agg(
        F.coalesce(F.sum((F.col("low") == 1).cast("int")), F.lit(0)), F.coalesce(F.sum((F.col("high") == 0).cast("int")), F.lit(0))
    ).first()
    n_docs = docs.where(~held_out(F.col("doc_id"))).count()
    good = trusted.where(F.col("low") == 1).where(_chosen(F.col("doc_id"), min(1, max_positive / max(n_good, 1)), 1))
    # at most about max_positive ids
    marked = docs.select("doc_id", "text").join(F.broadcast(good.select("doc_id", F.lit(True).alias("positive"))), "doc_id", "left")
    other = ~held_out(F.col("doc_id")) & _chosen(F.col("doc_id"), min(1, max_unlabelled / max(n_docs, 1)), 2)
    sample = marked.select("text", F.coalesce("positive", F.lit(False)).alias("positive"), F.coalesce(other, F.lit(False)).alias("other"))

    def featurise(batches):
        for batch in (part for whole in batches for part in W.slices(whole, limit=WINDOW)):
            x = pa.array(list(features(batch.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, batch.column("positive"), batch.column("other")], ["x", "positive", "other"])

    rows = sample.where("positive or other").mapInArrow(featurise, "x array<double>, positive boolean, other boolean").toArrow()
    x = np.array(rows["x"].combine_chunks().flatten()).reshape(-1, FEATURES)
    positive, unlabelled = x[rows["positive"].to_numpy()], x[rows["other"].to_numpy()]
    if not len(positive) or not len(unlabelled):
        return fit(positive, unlabelled, 0.5)
    if n_good and n_bad:
        return fit(positive, unlabelled, float(np.clip(n_good / (n_good + n_bad), 0.02, 0.98)))
    first = fit(positive, unlabelled, 0.5)
    return fit(positive, unlabelled, tail_prior(first.logits(positive), first.logits(unlabelled)))


def score(docs: DataFrame, network: Network, name: str = "score") -> DataFrame:
    """The documents with all their columns and a score from 0 to 1."""
    model = docs.sparkSession.sparkContext.broadcast(network)
    at = docs.columns.index("text")

    def run(batches):
        for batch in (part for whole in batches for part in W.slices(whole, limit=WINDOW)):
            score = model.value.score(features(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def graded(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """One row per document: whether it is held out, its score, and the class at 0.5."""
    docs = docs.select("doc_id", "text")
    return score(docs, train(docs, labels, **how)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that score at least 0.5, with their own columns."""
    mark = "_quality_score"
    while mark in docs.columns:
        mark += "_"
    return score(docs, train(docs, labels, **how), mark).where(F.col(mark) >= 0.5).drop(mark)
