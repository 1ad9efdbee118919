from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adtally.llm import token_counts
from adtally.llm.common import Stages
from adtally.llm.queries import word_tokenizer
from adtally.llm.tokens import WordTokenizer

PARTS = ["'s", "'re", "'", "a", "S", "É", "ß", "×", "¿", "!", "..", "23", " ", "\n", "'VE", "ğ", "İ", "<|endoftext|>", "—", "é", "\x0b", "word"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_tokenizer())


def size(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_ids_equal_the_tokenizers(tokenizer):
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["", None]
    for text, ids in zip(texts, WordTokenizer.of(word_tokenizer()).ids(pa.array(texts)), strict=True):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def plain_edit(text, edits):
    out, at, applied, n = [], 0, 0, len(text)
    clipped = [(min(max(s, 0), n), min(max(s, 0) + max(k, 0), n), str(e), r or "") for e, s, k, r in edits if s is not None and k is not None]
    for low, high, _, new in sorted(set(clipped)):
        if low >= at:
            out += [text[at:low], new]
            at, applied = high, applied + 1
    return "".join([*out, text[at:]]), applied


def test_counts_after_edits(spark, tokenizer):
    rng = random.Random(5)
    words = ["tion", "an", "ero", "the", "it's", "42", "(x)", "né", "\n", "  "]
    docs, edits = [], []
    for k in range(60):
        n = rng.choice([0, 3, 300, 1500])
        text = " ".join(rng.choice(words) for _ in range(n)) if k != 7 else "x" * 5000
        docs.append((k, text, "extra"))
        for e in range(rng.randint(0, 12)):
            start = rng.choice([0, len(text), rng.randint(-5, len(text) + 5), 1024 * rng.randint(0, 4)])
            edits.append((k, e, start, rng.choice([0, 0, 1, 7, 60, 2500]), rng.choice([None, "", "x", " new text ", "'s"])))
    docs += [(100, None, "null text"), (None, "no id at all", "x"), (5, docs[5][1], "repeated row")]
    edits += [(None, 1, 0, 3, "x"), (999, 1, 0, 3, "x"), (3, 50, None, 3, "x"), edits[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string, copy string")
    e = spark.createDataFrame(edits, "doc_id long, edit_id int, start int, length int, replacement string")
    got = {r.doc_id: r for r in token_counts.counted_with_edits(d, e, word_tokenizer()).collect()}
    assert set(got) == {*range(60), 100, None}
    for k, text, _ in docs[:62]:
        after, applied = plain_edit(text or "", [x[1:] for x in edits if x[0] == k] if k is not None else [])
        assert (got[k].tokens_before, got[k].tokens_after) == (size(tokenizer, text or ""), size(tokenizer, after)), k
        assert got[k].edits == applied
    assert got[8].segments >= 1 and got[7].segments == 1
    long = max((r for r in got.values() if 0 < r.segments_encoded), key=lambda r: r.segments)
    assert long.segments > 3


def test_nodes_are_sums_and_only_touched_segments_are_encoded(spark):
    text = " ".join(["word"] * 20_000)
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    stages = Stages(spark, "test")
    leaves, nodes = token_counts.build(d, word_tokenizer(), stages)
    e = spark.createDataFrame([(1, 1, 50_002, 1, "")], "doc_id long, edit_id int, start int, length int, replacement string")
    changed, updated = token_counts.apply_edits(d, leaves, nodes, e, word_tokenizer(), stages)
    assert changed.count() == 1
    by_level = {(r.level): r.n for r in updated.groupBy("level").sum("n_tokens").withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert len(set(by_level.values())) == 1 and len(by_level) == 3
    assert updated.where("level = 2").count() == 1


def test_only_edited_texts_travel(spark):
    """With edits on one document in a hundred, that share of the texts is packed, and stored counts need no other text."""
    d = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), F.repeat(F.concat("id", F.lit(" words ")), 300)).alias("text"))
    e = d.where("doc_id % 100 = 7").selectExpr("doc_id", "1 AS edit_id", "5 AS start", "3 AS length", "'new' AS replacement")
    stages = Stages(spark, "test")
    stored = token_counts.build(d, word_tokenizer(), stages)
    touched = token_counts._touched(e, stored[0])
    texts = token_counts.edited_texts(d, touched)
    ids = {r.doc_id for r in texts.select("doc_id").collect()}
    assert {k for k in range(2000) if k % 100 == 7} <= ids and len(ids) < 30
    found = texts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in found and "SortMergeJoin" not in found
    want = sorted(map(tuple, token_counts.counted_with_edits(d, e, word_tokenizer()).collect()))
    assert sorted(map(tuple, token_counts.counted_with_edits(d, e, word_tokenizer(), stored).collect())) == want
    assert sum(r[5] for r in want) == 20


def test_a_full_bit_table_still_finds_all(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "MARKS", 3)
    d = spark.range(50).selectExpr("id AS doc_id", "concat('some text ', id) AS text")
    e = d.selectExpr("doc_id", "1 AS edit_id", "0 AS start", "4 AS length", "cast(null AS string) AS replacement")
    assert {r.edits for r in token_counts.counted_with_edits(d, e, word_tokenizer()).collect()} == {1}


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    e = spark.createDataFrame([], "doc_id long, edit_id int, start int, length int, replacement string")
    assert token_counts.counted_with_edits(d, e, word_tokenizer()).count() == 0
