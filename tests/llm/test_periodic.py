"""Periodic runs against a plain version, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from adtally.llm import periodic
from tests.conftest import got

SCHEMA = "doc_id long, text string, words string, n_runs long, start long, runs string, best int, a int, p int, n int, g int"  # clashing names


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3, 4, 5, 6, 7) for i, t in docs], SCHEMA)


def plain_runs(s, least=6, times=4):
    found = set()
    for q in range(1, len(s)):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            shorter = any(q % d == 0 and all(s[k] == s[k + d] for k in range(i, i + length - d)) for d in range(1, q))
            if length >= max(least, times * q) and not shorter:
                found.add((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(rng, words, longest, kinds):
    s = []
    while len(s) < rng.randint(0, words):
        if rng.random() < 0.5:
            s += [rng.randint(1, kinds) for _ in range(rng.randint(1, 6))]
        else:
            root = [rng.randint(1, kinds) for _ in range(rng.randint(1, 9))]
            s += (root * 9)[: rng.randint(1, longest)]
    return s


@pytest.mark.parametrize("times, least", [(2, 2), (4, 6)])
def test_runs_of_a_sequence(times, least):
    rng = random.Random(times)
    for _ in range(400):
        s = repetitive(rng, 50, 30, rng.choice([1, 2, 3, 5]))
        assert [tuple(r) for r in periodic.runs_of(s, least, times).tolist()] == plain_runs(s, least, times), s


def test_extensions_are_common_prefixes():
    rng = random.Random(5)
    s = [rng.randint(1, 2) for _ in range(120)]
    tree = periodic.Suffixes(s)
    import numpy as np

    a, b = np.array([(i, j) for i in range(120) for j in range(120) if i != j]).T
    plain = [next((k for k in range(120) if max(i, j) + k >= 120 or s[i + k] != s[j + k])) for i, j in zip(a, b, strict=True)]
    assert tree.extensions(a, b).tolist() == plain
    assert [s[i:] for i in np.argsort(tree.rank)[1:]] == sorted(s[i:] for i in range(120))


def documents(rng):
    out = []
    for i in range(80):
        kinds = rng.choice([1, 3, 300])
        words = [f"w{x}" if x % 3 else f"W{x}" for x in repetitive(rng, 150, 60, kinds)]
        out.append((i, "".join(w + rng.choice([" ", "\n", " \t", "\r\n"]) for w in words)))
    return out + [(200, None), (201, ""), (202, " \n"), (203, "é é é É é é é é é é"), (None, "a a a a a a a"), (None, None), out[0], out[0]]


def plain_looped(i, words):
    h = 1 if i is None else zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]


def test_report_equals_the_plain_version(spark):
    docs = documents(random.Random(7))
    want = []
    for i, text in docs:
        words = plain_looped(i, (text or "").encode().split())
        runs = plain_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want.append((i, len(runs), s, n, q, n and 1000 * n // q, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    out = periodic.report(periodic.looped(frame(spark, docs).repartition(3)))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got(out) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert sum(r[1] for r in want) > 60


def test_longest_run_and_collapsed_text(spark):
    rows = {r.doc_id: r for r in periodic.periodic_runs(frame(spark, [(1, "x " + "a b " * 4 + "c " + "d " * 8 + "e"), (2, "a b a b a b a")])).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(1, 8, 2), (10, 8, 1)]
    assert rows[1].collapsed == "x a b c d e"
    assert rows[2].runs == [] and rows[2].collapsed == "a b a b a b a"


def test_no_rows(spark):
    assert periodic.report(periodic.looped(frame(spark, []))).count() == 0


def test_long_texts(spark):
    """A stretch of a quarter million words, and prose of a million words without a run."""
    rng = random.Random(11)
    block = [str(rng.randint(0, 999)) for _ in range(25_000)]
    prose = " ".join(str(rng.randint(0, 99_999)) for _ in range(1_000_000))
    rows = {r.doc_id: r for r in periodic.periodic_runs(frame(spark, [(1, " ".join(block * 10)), (2, prose)])).collect()}
    assert (0, 250_000, 25_000) in [tuple(r) for r in rows[1].runs]
    assert rows[2].collapsed == prose or rows[2].runs
