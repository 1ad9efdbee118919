"""Every scheduled load, twice, on the test tables: a rerun changes nothing."""

from __future__ import annotations

from datetime import datetime

import pytest

from adtally import jobs
from testbed.tables import Testbed
from tests.conftest import got

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 16, 11, 10)
CHAIN = ["publisher_revenue", "allocation"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("reports")
    tb = Testbed.of(spark, SF)
    db = "jobs_probe"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}'")
    spark.catalog.setCurrentDatabase(db)
    current = jobs.Run(spark, tb, AS_OF, str(root))
    for name in CHAIN:
        jobs.JOBS[name](current)
    lines = tb("partner_lines").where("iso_day = '2024-01-15'").select("value")
    lines.write.text(current.path("partner/2024-01-15.csv"))
    documents = {
        "advertisers": "named_struct('data', array(named_struct('code', adv_id, 'contractCode', contract_code)))",
        "customers": "named_struct('code', contract_code)",
        "channels": "named_struct('code', payee_code)",
    }
    for kind, doc in documents.items():
        tb(f"contract_{kind}").selectExpr(f"to_json({doc}) AS value").write.text(current.path(f"contracts/{kind}"))
    yield current
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE {db} CASCADE")


def written(run, name):
    """Rows of the catalog table or parquet folder the job wrote, if it is one."""
    if run.spark.catalog.tableExists(name):
        return got(run.spark.table(name))
    try:
        return got(run.spark.read.parquet(run.path(name)))
    except Exception:
        return None


OUTPUTS = {"slot_rollups": "slot_requests", "profit_backfill": "profit_report", "af_report": "af_report_normalized"}


@pytest.mark.parametrize("name", [n for n in jobs.JOBS if n not in (*CHAIN, "clear_counters")])
def test_job_runs_and_reruns(run, name):
    jobs.JOBS[name](run)
    first = written(run, OUTPUTS.get(name, name))
    jobs.JOBS[name](run)
    assert written(run, OUTPUTS.get(name, name)) == first


def test_counters_clear(run):
    for name in jobs.COUNTER_TABLES:
        jobs.JOBS[name](run)
    jobs.JOBS["clear_counters"](run)
    assert all(written(run, n) == [] for n in jobs.COUNTER_TABLES)


def test_jobs_take_one_bucket(run):
    assert {r.time_slot for r in run.spark.table("hour_report").collect()} <= {"2024011610"}
    assert {r.day for r in run.spark.table("allocation").collect()} == {"20240115"}


def test_bad_arguments_are_refused():
    with pytest.raises(SystemExit):
        jobs.main(["no_such_job", "--as-of", "2024-01-01T00:00", "--root", "/tmp/x"])


def test_jobs_write_rows(run):
    """The instant lies inside the data, so the day reports have rows."""
    for name in ("offer_conv_click", "day_report_all", "channel_day_report", "day_platform_report", "slot_rollups", "offer_dimension", "partner_report"):
        jobs.JOBS[name](run)
        assert written(run, OUTPUTS.get(name, name)), name
