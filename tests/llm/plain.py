"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def jaccard_components(docs, percent=80):
    sets = {i: shingles(t) for i, t in docs}
    ids = [i for i in sets if sets[i]]
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = least_reachable(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def repeats(docs, length=50):
    """id -> (bytes, removed, spans, kept) per row, in order"""
    data = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in data:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(first.get(w, math.inf), math.inf if i is None else i)
    out = []
    for i, b in data:
        gone = [False] * (len(b) + 1)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < (math.inf if i is None else i):
                gone[k : k + length] = [True] * length
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def contamination(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = benchmark_words(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        words, hit, found = benchmark_words(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if (w := tuple(words[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(str(x) for x in found if x is not None)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found - {None}), digest, bool(hit)))
    return out


def best_fit(lengths, capacity):
    """Rooms left in the bins of best-fit decreasing."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        best = min((k for k, r in enumerate(rooms) if r >= n), key=lambda k: rooms[k], default=None)
        if best is None:
            rooms.append(capacity - n)
        else:
            rooms[best] -= n
    return sorted(rooms)


def quality_features(text):
    """The classifier's 24 numbers, counted byte by byte and word by word."""
    body = (text or "").encode()

    def kind(c):
        if 65 <= c <= 90:
            return "upper"
        if 97 <= c <= 122:
            return "lower"
        if 48 <= c <= 57:
            return "digit"
        if c in b"\t\x0b\x0c\r ":
            return "space"
        named = {10: "break", ord(","): "stop", ord("."): "stop", ord("|"): "bar", ord("!"): "mark", ord("?"): "mark"}
        return named.get(c, "high" if c >= 128 else "sign")

    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", body) if w]
    if not words:
        return [math.log1p(len(body)), *[0.0] * 23]
    share = lambda k: math.sqrt(sum(kind(c) == k for c in body) / len(body))
    lines, n = body.count(b"\n") + 1, len(words)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    signs = [sum(kind(c) in ("sign", "mark", "bar") for c in w) for w in words]
    shouted = [sum(kind(c) == "upper" for c in w) >= 2 and not any(kind(c) in ("lower", "high") for c in w) for w in words]
    low = [w.lower() for w in words]
    again = [sum(a == b for a, b in zip(low, low[k:], strict=False)) for k in (1, 2)]
    times = [low.count(w) for w in set(low)]
    return [
        math.log1p(len(body)), math.log1p(n), mean, math.sqrt(max(sum(x * x for x in lengths) / n - mean * mean, 0)),
        math.log1p(len(body) / lines), math.log1p(n / lines),
        *[share(k) for k in ("upper", "lower", "digit", "space", "break", "high", "stop", "bar", "mark", "sign")],
        math.sqrt(sum(x >= 2 for x in signs) / n), math.sqrt(sum(x >= 1 for x in signs) / n), math.sqrt(sum(shouted) / n),
        *[math.sqrt(x / n) for x in again],
        len(times) / n, math.sqrt(max(times) / n), math.log1p(n) - math.log1p(len(times)),
    ]
