"""Lines, archives, licences, embeddings and quality scores: plain versions, defined cases, SQL at the smallest scale."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from plain import least_reachable, quality_features

from adtally.llm import embedding_dedup, licenses, line_dedup, quality, warc
from adtally.llm.queries import ORACLES, QUERIES
from testbed.compare import connect, difference

SF = "/root/testdata/sf0.001"


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- lines ---------------------------------------------------------------------------------


def test_lines_against_plain(spark):
    rng = random.Random(3)
    pool = [f"line {k}" for k in range(12)] + ["", "Menu", "Imprint"]
    docs = []
    for k in range(120):
        site = rng.choice(["a", "a", "a", "b", None])
        docs.append((k, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6))), site, "x", 1))
    docs += [(500, None, "a", "x", 1), (501, "", "a", "x", 1), (5, docs[5][1], docs[5][2], "x", 1), (None, "Menu\nMenu", "b", "x", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, site string, _drop int").drop("_drop")
    pages, counts = Counter(d[2] for d in docs), Counter()
    for d in docs:
        counts.update({(d[2], x) for x in (d[1] or "").split("\n") if x})
    gone = {k for k, n in counts.items() if n >= 3 and n > 0.3 * pages[k[0]]}
    want = []
    for i, text, site, _, _ in docs:
        parts = text.split("\n") if text is not None else []
        kept = [x for x in parts if (site, x) not in gone]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        want.append((i, site, len(parts), len(parts) - len(kept), digest))
    assert gone and tuples(line_dedup.line_report(df, ratio=0.3, min_pages=3)) == sorted(want, key=str)
    cleaned = line_dedup.remove_boilerplate(df, ratio=0.3)
    assert cleaned.columns == [*df.columns, "_lines", "_dropped"] and cleaned.where("doc_id = 500 and text is null").count() == 1
    assert line_dedup.line_report(df.limit(0)).count() == 0


def test_lines_by_host(spark):
    """Boilerplate of a small host inside a large source goes by host, where it does not reach the source's ratio."""
    rows = [(k, f"http://Small.example/{k}", f"Menu\nsmall {k}", "crawl") for k in range(5)]
    rows += [(100 + k, f"https://big{k % 20}.example:8080/{k}?q=1", f"big {k}", "crawl") for k in range(200)]
    rows += [(900, "not a url", "Menu", "crawl"), (901, None, None, "crawl")]
    df = spark.createDataFrame(rows, "doc_id long, url string, text string, source string")
    by_host = line_dedup.remove_boilerplate(line_dedup.with_host(df), site="host", ratio=0.1)
    assert by_host.where("_dropped > 0").count() == 5 and by_host.where("host = 'small.example' and text like '%Menu%'").count() == 0
    assert by_host.where("host is null").count() == 2 and by_host.where("doc_id = 900 and text = 'Menu'").count() == 1
    assert line_dedup.remove_boilerplate(df, ratio=0.1).where("_dropped > 0").count() == 0
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = line_dedup.with_host(pages)
    want = {re.match(r"https?://([^/:?#]+)", r.url)[1].lower() for r in pages.select("url").collect()}
    assert {r.host for r in found.select("host").distinct().collect()} == want and len(want) > 1
    cleaned = line_dedup.remove_boilerplate(found, site="host", text="html").select("url", "host", "html", "_dropped").collect()
    hosts, counts = Counter(r.host for r in found.collect()), Counter()
    for r in found.collect():
        counts.update({(r.host, x) for x in r.html.split("\n") if x})
    gone = {k for k, n in counts.items() if n >= 3 and n > 0.1 * hosts[k[0]]}
    assert sorted((r.url, r.html) for r in cleaned) == sorted(
        (r.url, "\n".join(x for x in r.html.split("\n") if (r.host, x) not in gone)) for r in found.collect()
    )


# --- archives ------------------------------------------------------------------------------


def page_rows():
    long, other = "<p>" + "x" * 200, "<p>é" + "y" * 300 + "\r\n\r\n tail"
    rows = [(4, "http://a/4", long), (2, "http://a/2", long), (9, None, other), (7, "http://a/\r\nb", other), (5, "u", "short"), (6, "u", "short")]
    rows += [(1, "u", None), (3, "u", ""), (11, "u", "z" * 99), (12, "u", "z" * 99), (13, "u", "w" * 100), (14, "u", "w" * 100)]
    return rows + [(20, "u", long), (20, "u", long), (None, "u", long), (21, "u", "v" * 500), (21, "u", "unique " * 50)]


def test_archives(spark, tmp_path):
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in page_rows()], "page_id long, url string, html string, file string").repartition(4)
    want = []
    for i, _, html in page_rows():
        data = (html or "").encode()
        same = sorted(p for p, _, h in page_rows() if (h or "") == (html or "") and p is not None)
        again = len(data) >= 100 and i != same[0]
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", same[0] if again else None))
    assert tuples(warc.deduplicate(df)) == sorted(want, key=str)


def test_equal_pages_give_one_response(spark):
    df = spark.createDataFrame([(1, "u", "a" * 100)] * 5, "page_id long, url string, html string").repartition(3)
    assert Counter(r.record_type for r in warc.deduplicate(df).collect()) == {"response": 1, "revisit": 4}
    assert warc.deduplicate(df.limit(0)).count() == 0


def test_archive_files_are_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/1", "b" * 150), (2, "http://a/2", "b" * 150)], "page_id long, url string, html string").coalesce(1)
    files = spark.createDataFrame(warc.write_responses(df, f"file://{tmp_path}/raw").collect())
    new = warc.resolve(files, f"file://{tmp_path}/new").collect()
    assert sum(f.records for f in new) == 2
    text = gzip.decompress(Path(new[0].file.removeprefix("file://")).read_bytes()).decode()
    records = re.split(r"(?=WARC/1\.1\r\n)", text)[1:]
    assert [re.search(r"WARC-Type: (\w+)", r)[1] for r in records] == ["response", "revisit"]
    assert "WARC-Refers-To: <urn:page:1>" in records[1] and "b" * 150 not in records[1]
    for r in records:
        head, _, rest = r.partition("\r\n\r\n")
        assert len(rest.encode()) == int(re.search(r"Content-Length: (\d+)", head)[1]) + 4


# --- licences ------------------------------------------------------------------------------


def test_licences(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    wrapped = "Redistribution and use in source and binary forms,\nwith or without modification, are permitted\nprovided that the following conditions are met:"
    rows = [
        (1, "a/b/x.txt", "some text\n" + mit), (2, "a/b/y.txt", "nothing here"), (3, "a/LICENSE", apache), (4, "a/b/c/z.txt", "plain"),
        (5, "a/b/COPYING.md", "MIT: " + mit), (6, "q/r.txt", "plain"), (7, "a", None), (8, None, mit), (9, "a/b/x.txt", ""),
        (10, "lic/LICENCE", wrapped), (11, "lic/deep/er/f", "words " * 2000), (12, "notes/NOTICE", "of the and in"), (2, "a/b/y.txt", "nothing here"),
        (13, "tie/license-a", mit), (14, "tie/license-b", apache), (15, "tie/f", ""), (16, "abc/f", ""), (None, "a/b/n", None),
    ]
    filler = [(100 + k, f"z/{k}", "the of and under a version\nlicense plate") for k in range(30)]
    df = spark.createDataFrame([(*r, "x") for r in rows + filler], "doc_id long, path string, text string, licence string")
    got = defaultdict(list)
    for r in licenses.scan(df).collect():
        got[r.doc_id].append((r.licence, r.origin, r.declared_in))
    want = {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a/b"), 3: ("Apache-2.0", "own", None), 4: ("MIT", "inherited", "a/b"),
        5: ("MIT", "own", None), 6: (None, "none", None), 7: (None, "none", None), 8: ("MIT", "own", None), 9: ("MIT", "inherited", "a/b"),
        10: ("BSD-3-Clause", "own", None), 11: ("BSD-3-Clause", "inherited", "lic"), 12: (None, "none", None), 13: ("MIT", "own", None),
        14: ("Apache-2.0", "own", None), 15: ("Apache-2.0", "inherited", "tie"), 16: (None, "none", None), None: ("MIT", "inherited", "a/b"),
    }
    assert {k: v[0] for k, v in got.items() if k is None or k < 100} == want and len(got[2]) == 2
    assert all(got[100 + k] == [(None, "none", None)] for k in range(30))
    assert licenses.scan(df.limit(0)).count() == 0


def test_licences_over_several_lines(spark):
    texts = dict(licenses.whole_texts())
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n#\n" \
        "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version."  # fmt: skip
    bsd = "Copyright (c) 2020 A. Writer\nAll rights reserved.\n\n" + texts["BSD-3-Clause"]
    one_by_one = "\n".join("Licensed under the Apache License, Version 2.0.".split())
    rows = [
        (1, "gpl/a.py", "#!/usr/bin/env python\n# a.py - sums\n" + gpl + "\n\nprint(1)"), (2, "gpl/b.m4", gpl.replace("#", "dnl")),
        (3, "gpl/c.py", "print(2)"), (4, "mit/LICENSE", texts["MIT"].replace("<copyright holders>", "A. Writer").replace(". ", ".\n")),
        (5, "mit/x/y.txt", "nothing"), (6, "bsd/LICENSE.txt", bsd), (7, "bsd/f", "nothing"), (8, "apache/COPYING", texts["Apache-2.0"]), (9, "apache/f", None),
        (10, "old/COPYING", texts["GPL-2.0"]), (11, "old/f", ""), (12, "w/f", one_by_one), (13, "w/g", "Released under\n" + "word " * 200 + "\nthe MIT License."),
        (14, "src/g", texts["ISC"]), (15, "isc/LICENCE", texts["ISC"]),
    ]
    filler = [(100 + k, f"z/{k}", "the of and under a version\nlicense plate") for k in range(30)]
    got = {r.doc_id: (r.licence, r.origin, r.declared_in) for r in licenses.scan(spark.createDataFrame(rows + filler, "doc_id long, path string, text string")).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {
        1: ("GPL-3.0", "own", None), 2: ("GPL-3.0", "own", None), 3: (None, "none", None), 4: ("MIT", "own", None), 5: ("MIT", "inherited", "mit"),
        6: ("BSD-3-Clause", "own", None), 7: ("BSD-3-Clause", "inherited", "bsd"), 8: ("Apache-2.0", "own", None), 9: ("Apache-2.0", "inherited", "apache"),
        10: ("GPL-2.0", "own", None), 11: ("GPL-2.0", "inherited", "old"), 12: ("Apache-2.0", "own", None), 13: (None, "none", None),
        14: (None, "none", None), 15: ("ISC", "own", None),
    }
    assert all(v == (None, "none", None) for k, v in got.items() if k >= 100)


def test_runs_against_plain(spark):
    """Notices cut into lines at random, with words of others around them: the best line or run of every text."""
    rng = random.Random(6)
    notices, rows = [text.split() for _, text in licenses.TEMPLATES], []
    for k in range(60):
        tokens = rng.choices(["some", "words", "here", "the", "of"], k=rng.randint(0, 12)) + rng.choice(notices) + rng.choices(["other", "and", "version"], k=rng.randint(0, 9))
        rows.append((k, "a/f", "".join(t + rng.choice([" ", " ", " ", "\n", "\n* ", "\n\n"]) for t in tokens if rng.random() < 0.95)))
    got = {r.doc_id: (r.licence, r.similarity) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    lines = [x for _, _, text in rows for x in text.split("\n")]
    frequency = Counter(t for x in lines for t in set(licenses.words(x)))
    model = licenses.Model(licenses.TEMPLATES, len(lines), frequency, 0.8)
    room = math.ceil(max(sum(bag.values()) for _, bag in model.bags) / 0.64)
    for k, _, text in rows:
        parts = [bag for bag in map(licenses.words, text.split("\n")) if bag]
        units = list(parts)
        for i in range(len(parts)):
            for j in range(i + 2, len(parts) + 1):
                unit = sum(parts[i:j], Counter())
                units += [unit] if sum(unit.values()) <= room else []
        best = (0.0, None)
        for unit in units:
            size = math.sqrt(sum((n * model.idf.get(t, model.unseen)) ** 2 for t, n in unit.items()))
            for (name, bag), norm in zip(model.bags, model.norm, strict=True):
                best = min(best, (-round(sum(unit[t] * n * model.idf[t] ** 2 for t, n in bag.items()) / size / norm, 6), name), key=lambda x: (x[0], x[1] or ""))
        if best[0] <= -0.8:
            assert got[k][0] == best[1] and got[k][1] == pytest.approx(-best[0], abs=2e-6)
        else:
            assert got[k] == (None, None)
    assert sum(v[0] is not None for v in got.values()) > 20


def test_anchors_lose_no_unit():
    rng = random.Random(2)
    vocabulary = sorted({t for _, text in licenses.TEMPLATES for t in licenses.words(text)})
    frequency = {t: rng.choice([0, 5, 5000, 90_000]) for t in vocabulary}
    model = licenses.Model(licenses.TEMPLATES, 100_000, frequency, 0.8)
    anchors = set(model.anchors)
    for _ in range(3000):
        bag = Counter(rng.choices(vocabulary, k=rng.randint(1, 25)))
        norm = math.sqrt(sum((n * model.idf[t]) ** 2 for t, n in bag.items()))
        best = max(
            sum(bag[t] * n * model.idf[t] ** 2 for t, n in template.items()) / norm / size
            for (_, template), size in zip(model.bags, model.norm, strict=True)
        )
        assert best < 0.8 or anchors & set(bag)


# --- embeddings ----------------------------------------------------------------------------


def plain_embeddings(rows, threshold):
    ok = {i: np.array(v, float) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = [
        (a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b])
        and ok[a] @ ok[b] / math.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= threshold
    ]
    found = least_reachable([i for i, _ in rows], links)
    n = Counter(x for pair in links for x in pair)
    return sorted((i, n[i], found[i], found[i] == i) for i, _ in rows)


@pytest.mark.parametrize(("width", "threshold"), [(3, 0.9), (64, 0.9), (50, 0.99)])
def test_embeddings(spark, width, threshold):
    rng = np.random.default_rng(width)
    rows = []
    for _ in range(25):
        base = rng.normal(size=width)
        for _ in range(rng.integers(1, 9)):
            rows.append((base + rng.normal(size=width) * rng.choice([0, 0.05, 0.3, 0.6])).tolist())
    rows += [[2 * x for x in rows[0]], rows[1], rows[1], [0.0] * width, None, [], [None, *rows[2][1:]], [math.nan, *rows[2][1:]], [math.inf, *rows[3][1:]], [1.0, 2.0], [1.0, 2.0]]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(rows)), rows, strict=True)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, v string")
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df, threshold).collect())) == plain_embeddings(rows, threshold)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("width", [3, 300])
def test_axes_are_those_of_the_whole_covariance(spark, width):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(700, width)) * np.arange(1, width + 1)
    axes = embedding_dedup.principal_axes(spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(5), width)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = axes.T @ (unit.T @ unit) @ axes
    assert np.allclose(axes.T @ axes, np.eye(width)) and np.allclose(found, np.diag(np.diag(found)), atol=1e-9)
    assert (np.diff(np.diag(found)) < 1e-9).all()
    nothing = embedding_dedup.principal_axes(spark.createDataFrame([], "v array<double>"), width)
    assert nothing.shape == (width, width)


def test_tiles_and_blocks_miss_no_pair():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([c + rng.normal(size=(40, 16)) * 0.25 for c in centres])
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    tree = embedding_dedup.Tree.fit(y[::3], 16)
    home, near = tree.tile(y), tree.near(y, math.sqrt(0.2))
    close = np.argwhere(np.triu(y @ y.T >= 0.9, 1))
    assert len(close) > 500 and len(np.unique(home)) == 16 and near.mean() < 1
    assert near[close[:, 0], home[close[:, 1]]].all() and near[close[:, 1], home[close[:, 0]]].all()

    def side(rows):
        return embedding_dedup.Side(pa.table({
            "rep": rows, "copies": np.ones(len(rows), np.int64), "v": pa.array(list(x[rows]), pa.list_(pa.float64())),
            "y": pa.array(list(y[rows]), pa.list_(pa.float64())),
        }))

    a, b = np.arange(0, 800), np.arange(800, 1600)
    i, j = embedding_dedup.linked(side(a), side(b), 0.9)
    want = np.argwhere(y[a] @ y[b].T >= 0.9)
    assert sorted(zip(i, j, strict=True)) == sorted(map(tuple, want))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings_of_one_kind_of_row(spark, kind):
    def found(*rows):
        out = embedding_dedup.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect()
        return sorted(map(tuple, out), key=str)

    unusable = found((3, None), (1, []), (None, [0.0]), (2, [None, 1.0]), (4, [math.inf, 1.0]))
    assert unusable == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (None, 0, None, False)]
    assert found((5, [0.0, 1.0]), (4, [-0.0, 1.0]), (None, [0.0, 1.0])) == [(4, 2, 4, True), (5, 2, 4, False), (None, 2, 4, False)]


def stored_bytes(spark):
    """Bytes of shuffles and of written tables."""
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = sum(f.stat().st_size for d in folders for f in Path(d).rglob("shuffle_*.data"))
    shared = Path(spark.conf.get("spark.checkpoint.dir")).rglob("embeddings-*/**/*.parquet")
    return shuffled + sum(f.stat().st_size for f in shared)


def test_embeddings_are_not_copied_to_the_tiles_they_meet(spark, monkeypatch):
    """Vectors without structure meet every tile; what is shuffled and written stays in proportion to the input."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "HELD", 1 << 18, raising=False)  # 1,024 vectors a round
    rng = np.random.default_rng(64)
    x = rng.normal(size=(2500, 64))
    x = np.concatenate([x, x[:300] + rng.normal(size=(300, 64)) * 0.2, x[2400] + rng.normal(size=(1200, 64)) * 0.1, x[:100], x[:50] * 2]).astype(np.float32)
    ids = rng.permutation(len(x))
    df = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<float>").repartition(6)
    write, stored = embedding_dedup.Stages.write, [stored_bytes(spark)]

    def watched(*args, **options):
        table = write(*args, **options)
        stored.append(stored_bytes(spark))  # before Spark drops shuffles that are no longer referred to
        return table

    monkeypatch.setattr(embedding_dedup.Stages, "write", watched)
    found = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()))
    assert max(stored) - stored[0] < 8 * x.nbytes

    unit = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    component = ids.copy()
    while (least := np.where(close, component, len(ids)).min(axis=1)).tolist() != component.tolist():
        component = least
    want = zip(ids.tolist(), (close.sum(axis=1) - 1).tolist(), component.tolist(), (ids == component).tolist(), strict=True)
    assert found == sorted(want)


def test_rounds_hold_every_tile():
    rounds = embedding_dedup._rounds({7: 3, 0: 4, 2: 25, 1: 6, 5: 10}, 10)
    assert rounds == [([0, 1], 0, 1), ([2], 0, 3), ([2], 1, 3), ([2], 2, 3), ([5], 0, 1), ([7], 0, 1)]


@pytest.mark.parametrize("tiles", [1, 2, 4, 16])
def test_of_two_tiles_one_looks(tiles):
    t = np.arange(tiles)
    looks = embedding_dedup._meet(t[:, None], t[None, :], tiles)
    assert looks.diagonal().all() and (looks ^ looks.T == ~np.eye(tiles, dtype=bool)).all()
    assert np.ptp(looks.sum(axis=1)) <= 1


# --- quality -------------------------------------------------------------------------------


def quality_texts(seed):
    rng = random.Random(seed)
    parts = ["Word", "WORD", "word", "a", "é", "ÉÉ", "!!", "#$", "|", "12", "a,b.", "x?y!", "\x00\x01", "OK9", "--"]
    gaps = [" ", " ", "  ", "\n", "\r\n", "\t", "\x0b"]
    texts = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 2, 30, 300]))) for _ in range(60)]
    return texts + [None, "", " \n ", "one", "one one ONE two one"]


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_features_equal_the_plain_version(seed):
    texts = quality_texts(seed)
    want = np.array([quality_features(t) for t in texts])
    assert np.allclose(quality.features(pa.array(texts, pa.string())), want, atol=1e-9)
    assert np.allclose(quality.features(pa.array([None, *texts], pa.string()).slice(1)), want, atol=1e-9)


@pytest.mark.parametrize("window", [5, 64, 1000])
def test_quality_features_of_windows_equal_the_plain_version(monkeypatch, window):
    monkeypatch.setattr(quality, "WINDOW", window)
    for text in quality_texts(3):
        assert np.allclose(quality.features(pa.array([text], pa.string())), [quality_features(text)], atol=1e-9)


@pytest.mark.parametrize("side", [True, False])
def test_quality_step_follows_the_risk(side):
    """One row of each kind is one first step, which goes by the rate against each derivative's sign; on the other side of the
    switch the derivatives are those of the negative part, undone."""
    rng, prior, found = np.random.default_rng(9), 0.9, False
    for _ in range(20):
        positive, unlabelled = rng.normal(size=(1, quality.FEATURES)), rng.normal(size=(1, quality.FEATURES))
        before, after = (quality.fit(positive, unlabelled, prior, hidden=3, epochs=k) for k in (0, 1))

        def negative_part(net):
            zp, zu = float(net.logits(positive)[0]), float(net.logits(unlabelled)[0])
            return math.log1p(math.exp(zu)) - prior * math.log1p(math.exp(zp)), prior * math.log1p(math.exp(-zp))

        if (negative_part(before)[0] >= 0) != side:
            continue
        found = True

        def risk():
            negative, positive_part = negative_part(before)
            return positive_part + negative if side else -negative

        for k, (old, new) in enumerate(zip(before.weights, after.weights, strict=True)):
            for at in np.ndindex(old.shape):
                here, width = old[at], 1e-5
                old[at] = here + width
                up = risk()
                old[at] = here - width
                slope = (up - risk()) / (2 * width) + 1e-5 * here * (k != 3)
                old[at] = here
                if abs(slope) > 1e-5:
                    assert math.isclose((here - new[at]) / 5.1e-3, math.copysign(1, slope), rel_tol=1e-2), (k, at)
    assert found


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scores = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in scores.items())
    own = [(r.quality, scores[r.doc_id].predicted) for r in labels if scores[r.doc_id].held_out]
    assert len(own) > 80 and sum(a == b for a, b in own) / len(own) >= 0.97
    assert spark.read.parquet(f"{sf}/documents.parquet").count() == len(scores)


def test_scores_ignore_labels_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(CAST(doc_id AS STRING)), 3) = 1 THEN 1 - quality ELSE quality END AS quality")
    assert tuples(quality.graded(docs, labels)) == tuples(quality.graded(docs, flipped))


def test_quality_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "word " * 50_000, "x"), (None, "no id", "x"), (3, "again", "x")], "doc_id long, text string, score string"
    )
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.graded(docs, nothing).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.5}
    some = spark.createDataFrame([(1, 1), (3, 1), (3, 0), (None, 1), (2, None), (77, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.graded(docs, some).collect())
    assert quality.keep_good(docs, some).columns == docs.columns
    assert quality.graded(docs.limit(0), some).count() == 0


def test_prior_from_tails():
    rng = np.random.default_rng(1)
    positive = rng.normal(2, 1, 5000)
    mixed = np.concatenate([rng.normal(2, 1, 3500), rng.normal(-2, 1, 1500)])
    assert 0.6 < quality.tail_prior(positive, mixed) < 0.75


# --- queries -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


@pytest.mark.parametrize("clash", ["_site", "_drop", "_kept", "_lines", "_dropped", "_DROP", "site", "line", "n", "pages", "of"])
def test_line_dedup_with_clashing_columns(spark, clash):
    docs = spark.createDataFrame([(k, f"menu\nown {k}", "a", f"x{k}") for k in range(9)], f"doc_id long, text string, source string, `{clash}` string")
    out = line_dedup.remove_boilerplate(docs, ratio=0.3, min_pages=3).orderBy("doc_id").collect()
    assert [(r.text, r["_lines"], r["_dropped"]) for r in out] == [(f"own {k}", 2, 1) for k in range(9)]
    if clash not in ("_lines", "_dropped"):
        assert [r[clash] for r in out] == [f"x{k}" for k in range(9)]
    kept = line_dedup.remove_boilerplate(docs, ratio=0.3, min_pages=3, counts=("a", "b"))
    assert kept.columns == [*docs.columns, "a", "b"] and sorted(r[clash] for r in kept.collect()) == [f"x{k}" for k in range(9)]
