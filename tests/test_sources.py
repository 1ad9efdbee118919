from __future__ import annotations

import json

import pytest

from adtally.sources import contracts, partner_csv, tables
from tests.conftest import got


def test_partner_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "\n".join(
            [
                '"day","country","platform","pkg","x","channel","imp","click","conv","revenue","cost","y"',
                '"2024-01-01","US","Android","com.a","x","ch1","10","4","2","1.5","0.5","y"',
                "2024-01-01,US,iOS,com.a,x,ch1,10,5,3,2.5,1.5,y",
                "2024-01-01,US,web,com.a,x,ch1,10,1,1,1,1,y",
                "2024-01-01,US,iOS,com.a,x,ch1,10,5,3,2.5,1.5",
                "",
            ]
        )
    )
    out = partner_csv.read_partner_csv(spark, str(tmp_path / "p.csv"))
    assert out.columns == [
        "date", "channel_type", "platform", "channel", "country", "pkg", "conversion", "revenue", "cost", "click", "install",
    ]
    assert got(out.select("platform", "conversion", "revenue", "click", "install")) == [
        ("1", 2, 1.5, 4, 0), ("2", 1, 1.0, 1, 0), ("2", 3, 2.5, 5, 0),
    ]


def test_contract_feeds(spark, tmp_path):
    def feed(name, *docs):
        path = tmp_path / name
        path.write_text("\n".join(json.dumps(d) for d in docs))
        return str(path)

    adv = feed("a.json", {"data": [{"code": "A1", "contractCode": "C1"}, {"code": "A2", "contractCode": "C2"}]})
    cust = feed("c.json", {"code": "C1", "data": {"customerContractRes": {"currency": "CNY"}}}, {"code": "C2", "data": None}, {"code": "C3"})
    chan = feed(
        "h.json",
        {"code": "K1", "data": {"contractList": [{"channelContractRes": {"code": "S1", "currency": "USD"}}, {"channelContractRes": {"code": "S9"}}]}},
        {"code": "K2", "data": {"contractList": []}},
        {"code": "K3", "data": None},
    )
    assert got(contracts.read_advertisers(spark, adv)) == [("A1", "C1"), ("A2", "C2")]
    assert got(contracts.read_customer_contracts(spark, cust)) == [("C1", "CNY"), ("C2", ""), ("C3", "")]
    assert got(contracts.read_channel_contracts(spark, chan)) == [("K1", "S1", "USD"), ("K2", "", ""), ("K3", "", "")]


def test_jdbc_options_come_from_the_caller():
    conn = {"url": "jdbc:x", "user": "u"}
    assert tables.jdbc_options(conn, "t") == {"url": "jdbc:x", "user": "u", "dbtable": "t", "fetchsize": "10000"}
    split = tables.jdbc_options(conn, "t", split_on="id", bounds=(0, 99), splits=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "99", "4")
    with pytest.raises(ValueError):
        tables.jdbc_options(conn, "t", split_on="id")


def test_scans_prune_columns(spark, rows, tmp_path):
    rows("a string, b long, c long", ("x", 1, 2)).write.parquet(str(tmp_path / "p"))
    df = tables.scan_parquet(spark, str(tmp_path / "p"), ["a", "c"])
    assert "ReadSchema: struct<a:string,c:bigint>" in df._jdf.queryExecution().executedPlan().toString()
    df.write.saveAsTable("scan_probe")
    assert got(tables.scan_table(spark, "scan_probe", ["c"])) == [(2,)]
    spark.sql("DROP TABLE scan_probe")


def test_register_partition(spark, rows, tmp_path):
    rows("a string", ("x",)).write.parquet(str(tmp_path / "elsewhere"))
    spark.sql(f"CREATE TABLE reg_probe (a string, pdate string) USING parquet PARTITIONED BY (pdate) LOCATION '{tmp_path}/t'")
    for _ in range(2):
        tables.add_partition(spark, "reg_probe", "pdate", "20240101", str(tmp_path / "elsewhere"))
    assert got(spark.table("reg_probe")) == [("x", "20240101")]
    with pytest.raises(ValueError):
        tables.add_partition(spark, "reg_probe", "pdate", "x' OR '1", "/tmp")
    spark.sql("DROP TABLE reg_probe")
