"""Documents without a fixed schema, and the ledger of input files."""

from __future__ import annotations

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from adtally.sources import documents, ledger
from adtally.sources.documents import Field
from testbed import scaled
from testbed.tables import Testbed
from tests.conftest import got
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"
FIELDS = [Field("code", "$.code", "string", required=True), Field("n", "$.a.n", "long"), Field("on", "$.list[0]", "boolean")]


def test_fields_drift_and_breakage(spark, rows):
    texts = {
        1: '{"code": "x", "a": {"n": 3}, "list": [true, 2]}', 2: '{"code": "y", "a": {"n": "12"}, "new": {"deep": [1]}}', 3: '{"code": "z", "a": [7]}',
        4: '{"code": null, "a": {"n": 1}}', 5: '{"code": "x", "a": {"n": "many"}, "list": [[]]}', 6: '{"code": ', 7: None, 8: "", 9: "null", 10: '{"a": {"n": {}}}',
    }
    good, rejected = documents.read_documents(rows("id int, text string", *texts.items()), "text", FIELDS)
    assert got(good) == [(1, "x", 3, True), (2, "y", 12, None), (3, "z", None, None)]
    assert {r.id: r.reason for r in rejected.collect()} == {
        4: "missing: code", 5: "drifted: n, on", 6: "unreadable", 7: "unreadable", 8: "unreadable", 9: "missing: code", 10: "drifted: n; missing: code",
    }
    assert {r.id: r.text for r in rejected.collect()} == {k: v for k, v in texts.items() if k > 3}


def test_entries_of_a_list(spark, rows):
    df = rows("id int, text string", (1, '[{"v": 1}, {"v": null}, {"v": "no"}, 5, {"v": 2}]'), (2, "[]"), (3, '{"v": 1}'), (4, "[1"), (5, None))
    good, rejected = documents.read_entries(df, "text", "$", [Field("v", "$.v", "long", required=True)])
    assert got(good) == [(1, 0, 1), (1, 4, 2)]
    told = {(r.id, r.entry): (r.text, r.reason) for r in rejected.collect()}
    assert told == {
        (1, 1): ('{"v":null}', "missing: v"), (1, 2): ('{"v":"no"}', "drifted: v"), (1, 3): ("5", "missing: v"), (3, None): ('{"v": 1}', "no list"),
        (4, None): ("[1", "unreadable"), (5, None): (None, "unreadable"),
    }


def test_every_document_is_read_or_rejected(spark):
    t = Testbed.of(spark, SF)
    good, rejected = scaled.contract_documents(t)
    texts = t("contract_texts")
    assert good.count() + rejected.count() == texts.count() and min(good.count(), rejected.count()) > 0
    assert got(good.select("id").unionAll(rejected.select("id"))) == got(texts.select("id"))
    assert set(r.reason for r in rejected.select("reason").distinct().collect()) == {
        "unreadable", "drifted: amount", "missing: code", "drifted: amount; missing: code",
    }


def test_documents_are_parsed_once(spark):
    """Both outputs read what one pass has written."""
    for df in (*scaled.contract_documents(Testbed.of(spark, SF)), *scaled.cap_entries(Testbed.of(spark, SF))):
        found = plan(df)
        assert "parse_json" not in found and "variant" not in found and "FileScan" in found
        assert re.search(r"PushedFilters: \[(IsNull|IsNotNull)\(reason\)\]", found)


def test_observed_schema(spark, rows):
    df = rows("text string", ('{"a": 1, "b": ["x"]}',), ('{"a": 2.5, "c": null}',), ("broken",))
    assert documents.observed_schema(df, "text") == "OBJECT<a: DECIMAL(21,1), b: ARRAY<STRING>, c: VOID>" or "b: ARRAY<STRING>" in documents.observed_schema(df, "text")


# --- ledger ---------------------------------------------------------------------------------


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return [str(tmp_path / x) for x in ("in", "rows", "ledger")]


def put(folder, name, *values):
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(json.dumps({"v": v}) for v in values))


def run(spark, folders, **how):
    return ledger.load_new(spark, lambda path: spark.read.schema("v int").json(path), *folders, pattern="*.json", **how)


def rows_of(spark, folders):
    return got(ledger.loaded(spark, *folders[1:], "v int").select("v", "load"))


def test_each_file_is_taken_once(spark, folders):
    put(folders[0], "a.json", 1, 2)
    put(folders[0], "b.json", 3)
    assert run(spark, folders, load="one") == "one"
    assert run(spark, folders) is None
    put(folders[0], "c.json", 2)
    assert run(spark, folders, load="two") == "two"
    assert run(spark, folders) is None
    assert rows_of(spark, folders) == [(1, "one"), (2, "one"), (2, "two"), (3, "one")]
    assert ledger.entries(spark, folders[2]).count() == 3


def test_a_changed_file_is_refused(spark, folders):
    put(folders[0], "a.json", 1)
    run(spark, folders, load="one")
    put(folders[0], "a.json", 1, 9)
    put(folders[0], "new.json", 5)
    with pytest.raises(ledger.ChangedFiles, match="a.json"):
        run(spark, folders, load="two")
    assert rows_of(spark, folders) == [(1, "one")] and ledger.entries(spark, folders[2]).count() == 1
    os.utime(f"{folders[0]}/new.json", (1, 1))
    os.remove(f"{folders[0]}/a.json")  # a taken file may be cleared away
    assert run(spark, folders, load="three") == "three"
    assert rows_of(spark, folders) == [(1, "one"), (5, "three")]


def test_a_failed_load_leaves_the_ledger_and_its_rows_do_not_count(spark, folders, monkeypatch):
    put(folders[0], "a.json", 1)
    run(spark, folders, load="one")
    put(folders[0], "b.json", 2)
    with pytest.raises(Exception, match="broken"):
        run(spark, folders, load="two", make=lambda df: df.select(F.raise_error(F.lit("broken")).cast("int").alias("v")))
    # rows written, ledger entry not
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{folders[1]}/load=half")
    assert rows_of(spark, folders) == [(1, "one")] and ledger.entries(spark, folders[2]).count() == 1
    assert run(spark, folders, load="three") == "three"
    assert rows_of(spark, folders) == [(1, "one"), (2, "three")]
    assert sorted(x for x in os.listdir(folders[1])) == ["load=one", "load=three"]


def test_listing_reads_no_content(spark, folders):
    put(folders[0], "a.json", 1)
    found = plan(ledger.listed_files(spark, folders[0]))
    assert "content" not in re.search(r"ReadSchema: \S*", found).group(0)
