"""Product codes against a plain version, and their defined cases."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from adtally.llm import orchard_codes
from tests.conftest import got

SCHEMA = "vec_id long, embedding array<float>, label int, q int, code string, error long, n long, part int, entry int, s0 long"  # clashing names


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "x", 2, 3, 4, 5, 6) for i, v, lab in rows], SCHEMA)


def plain(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, labels = [], defaultdict(int)
    for width in sorted({len(v) for _, v, _ in kept}):
        own = [(i, v, lab) for i, v, lab in kept if len(v) == width]
        ends = [sum(len(x) for x in np.array_split(range(width), parts)[:k]) for k in range(parts + 1)]
        first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
        books = [[v[a:b] for _, v, _ in first] for a, b in zip(ends, ends[1:])]

        def near(x, book):
            return min((sum((p - q) ** 2 for p, q in zip(x, e)), k) for k, e in enumerate(book))

        for turn in range(rounds + 1):
            chosen = [[near(v[a:b], book) for book, a, b in zip(books, ends, ends[1:])] for _, v, _ in own]
            if turn == rounds:
                break
            for p, book in enumerate(books):
                for k in range(len(book)):
                    members = [v[ends[p] : ends[p + 1]] for (_, v, _), c in zip(own, chosen) if c[p][1] == k]
                    if members:
                        book[k] = [sum(xs) // len(members) for xs in zip(*members)]
        digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
        for (i, _, lab), c in zip(own, chosen):
            labels[lab] += sum(d for d, _ in c)
            out.append((i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), lab, digest))
    return [(i, code, error, labels[lab], digest) for i, code, error, lab, digest in out]


def compare(spark, rows, **how):
    out = orchard_codes.compressed(frame(spark, rows).repartition(3), **how)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got(out) == sorted(plain(rows, **how), key=lambda r: tuple((v is None, str(v)) for v in r))


def vectors(rng, n, width):
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(7)]
    return [
        (i, [float(np.float32(c + rng.gauss(0, 0.05))) for c in rng.choice(centres)], rng.choice([0, 0, 0, 1, None])) for i in range(n)
    ]


def test_codes_equal_the_plain_version(spark):
    rng = random.Random(1)
    rows = vectors(rng, 320, 8)
    rows += [(1000, None, 1), (1001, [None] * 8, 1), (1002, [math.nan] + [0.0] * 7, 1), (1003, [math.inf] + [0.0] * 7, 2), (1004, [0.0] * 8, None)]
    rows += [(2000 + k, rows[k][1], 3) for k in range(20)] + [rows[5], rows[5], (None, rows[9][1], None)]
    rng.shuffle(rows)
    compare(spark, rows)


@pytest.mark.parametrize("entries, rounds", [(3, 2), (16, 0)])
def test_ties_and_few_entries(spark, entries, rounds):
    rng = random.Random(entries)
    rows = [(i, [rng.choice([-0.01, 0.0, 0.01]) for _ in range(6)], i % 2) for i in range(40)]
    compare(spark, rows, parts=4, entries=entries, rounds=rounds)


def test_several_widths_and_empty_vectors(spark):
    rng = random.Random(3)
    compare(spark, vectors(rng, 12, 4) + [(i + 100, v, lab) for i, v, lab in vectors(rng, 9, 5)] + [(200, [], 1), (201, [], None)])


def test_search_finds_the_nearest_entry():
    rng = np.random.default_rng(5)
    for width, spread in ((1, 5), (3, 4), (16, 900)):
        entries = rng.integers(-spread, spread, (256, width))
        x = rng.integers(-spread, spread, (3000, width))
        away = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        for begin in (0, 255):
            best, least = orchard_codes.Codebook.of(entries).nearest(x, begin)
            assert (best == away.argmin(axis=1)).all() and (least == away.min(axis=1)).all()


def test_no_vectors(spark):
    assert orchard_codes.compressed(frame(spark, [])).count() == 0
    assert orchard_codes.compressed(frame(spark, [(1, None, 1)])).count() == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        orchard_codes.compressed(frame(spark, [(1, [1e30] * 4, 1)])).collect()


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rows = vectors(random.Random(8), 200, 8)
    whole = orchard_codes.usable(frame(spark, rows))
    coder = orchard_codes.fit(whole, 8, entries=32)
    codes = orchard_codes.encode(whole, coder)
    near = {r.vec_id: r.approximation for r in orchard_codes.decoded(codes, coder).collect()}
    given = {i: v for i, v, _ in rows}
    for r in codes.collect():
        entry = np.array(near[r.vec_id]) * 1024 - 0.5
        assert round(((np.floor(np.array(given[r.vec_id]) * 1024) - entry) ** 2).sum()) == r.error
