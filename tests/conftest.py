from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from adtally.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(schema, row, ...) -> DataFrame"""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


def got(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
