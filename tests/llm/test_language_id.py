"""Rank-order profiles against a plain version, and their defined cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adtally.llm import language_id
from adtally.llm import words as W
from tests.conftest import got

SCHEMA = "doc_id long, text string, lang string, gram int, n long, rank int, score double, lang_pred string"  # with columns whose names clash
FROM, TO = language_id._CAPITALS, language_id._CAPITALS.lower()


def plain_grams(text):
    cleaned = re.sub(r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", " ", (text or "").translate(str.maketrans(FROM, TO))).strip(" ")
    data = f" {cleaned} ".encode()
    out = Counter()
    for size in (1, 2, 3):
        for i in range(len(data) - size + 1):
            g = data[i : i + size]
            if g.strip(b" ") and b" " not in g.strip(b" "):
                out[g] += 1
    return out


def plain_ranks(counts, top):
    order = sorted(counts, key=lambda g: (-counts[g], len(g), g))
    return {g: k for k, g in enumerate(order[:top])}


def plain(docs, top):
    by_language = {}
    for i, text, lang in docs:
        if lang is not None and not (i is not None and zlib.crc32(str(i).encode()) % 5 == 0):
            by_language.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: plain_ranks(c, top) for lang, c in by_language.items() if c}
    out = []
    for i, text, _ in docs:
        own = plain_ranks(plain_grams(text), top)
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        if not profiles or not any(x.isalpha() for x in text or ""):
            out.append((i, held, "und", 0.0))
            continue
        away = {lang: sum(abs(p[g] - k) if g in p else top for g, k in own.items()) for lang, p in profiles.items()}
        lang = min(away, key=lambda x: (away[x], x))
        out.append((i, held, lang, 1 - away[lang] / (top * len(own))))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(i, t, lang, 1, 2, 3, 0.5, "x") for i, t, lang in docs], SCHEMA)


def samples(rng):
    letters = {"aa": "etaoin shr", "bb": "ÄÖÜßaenri ", "cc": "КОШка и ", "dd": "日本語 の。"}
    docs = []
    for i in range(60):
        lang = rng.choice(list(letters))
        text = "".join(rng.choice(letters[lang] + "E.1\n\t") for _ in range(rng.randint(1, 120)))
        docs.append((i, text, rng.choice([lang, lang, lang, None])))
    return docs + [
        (100, None, "aa"), (101, "", "aa"), (102, "123 -- !? \n", "bb"), (103, "—… ☃", "bb"), (104, "é", None), (105, "Ж", "cc"),
        (None, "etaoin", "aa"), (None, None, None), docs[0], docs[0], (107, "A\u0000B a×b", "aa"),
    ]


@pytest.mark.parametrize("seed, top", [(1, 20), (2, 400)])
def test_predictions_equal_the_plain_version(spark, seed, top):
    docs = samples(random.Random(seed))
    out = language_id.identified(frame(spark, docs).repartition(3), top)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rounded = [(i, h, lang, round(s, 12)) for i, h, lang, s in map(tuple, out.collect())]
    assert Counter(rounded) == Counter((i, h, lang, round(s, 12)) for i, h, lang, s in plain(docs, top))


def test_windows_of_a_long_text_add_up(monkeypatch):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(3000)) + " " + "x" * 5000
    batch = pa.record_batch([pa.array(["kurz", text, None, "ende"])], ["text"])

    def count():
        return {(low + (int(k) >> 24), int(k) & 0xFFFFFF): int(c) for low, _, ks, cs in language_id.counted(batch) for k, c in zip(ks, cs, strict=True)}

    whole = count()
    monkeypatch.setattr(language_id, "WINDOW", 700)
    assert count() == whole
    assert sum(c for (row, _), c in whole.items() if row == 1) == sum(plain_grams(text).values())
    body = b"ab cd " + b"y" * 2000 + b" z" * 900
    pieces = [p.tobytes() for p in W.windows(np.frombuffer(body, np.uint8), language_id._LETTER, 700)]
    assert b"".join(pieces) == body and len(pieces) > 2 and all(p.endswith(b" ") for p in pieces[:-1])


def test_more_rows_than_fit_a_key(spark):
    docs = [(i, "der die das und" if i % 2 else "the and of to", "de" if i % 2 else "en") for i in range(700)]
    found = language_id.identified(frame(spark, docs).coalesce(1))
    assert found.where((F.col("doc_id") % 2 == 1) != (F.col("lang_pred") == "de")).count() == 0


def test_nothing_learned_and_no_rows(spark):
    assert got(language_id.identified(frame(spark, [(1, "some words", None)]))) == [(1, False, "und", 0.0)]
    assert language_id.identified(frame(spark, [])).count() == 0


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identified(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, all_ = out.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right / all_ > 0.98
