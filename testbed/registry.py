"""Registry of queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from testbed.tables import Testbed, duck_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, tables: tuple[str, ...] = (), sql: str | None = None):
    """Register ``fn(testbed) -> DataFrame``; ``sql`` is a select (or more CTEs and a select)
    over ``tables``, starting with ``SELECT`` or with ``, cte AS (...)``."""

    def wrap(fn: Callable[[Testbed], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Testbed.of(spark, sf_dir))
        if sql is not None:
            head = duck_with(*tables) if tables else ""
            ORACLES[name] = f"{head}\n{sql}" if head else sql
        return fn

    return wrap


# --- SQL fragments for the reference side ------------------------------------------


def units(x: str) -> str:
    return f"CAST(ROUND(({x}) * 1e9) AS BIGINT)"


def exact(x: str) -> str:
    """Sum of doubles as decimals, so that it does not depend on their order."""
    return f"SUM(CAST({x} AS DECIMAL(28, 9)))"


def sum_units(x: str) -> str:
    return f"CAST({exact(x)} * 1000000000 AS BIGINT)"


def money(x: str) -> str:
    return f"CAST({exact(x)} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def half_even(x: str, digits: int = 0) -> str:
    return f"round_even(CAST({x} AS DOUBLE), {digits})"


def half_up(x: str, digits: int = 0) -> str:
    return f"(FLOOR(({x}) * 1e{digits} + 0.5E0) / 1e{digits})"


def share(part: str, whole: str) -> str:
    """Percentage of whole numbers, six decimals half-up in integers, then times 100."""
    return f"(CAST((2 * CAST({part} AS HUGEINT) * 1000000 + {whole}) // (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / 1e4)"
