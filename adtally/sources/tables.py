"""Log and dimension scans: parquet, catalog tables, JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.types import StructType

from adtally.operators.shape import sanitize_names


def scan_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def scan_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(table)
    return df if columns is None else df.select(*columns)


def scan_sanitized(df: DataFrame) -> DataFrame:
    """A scan whose result names may carry functions or blanks."""
    return sanitize_names(df)


def jdbc_options(
    connection: Mapping[str, str],
    table: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    fetch: int = 10_000,
) -> dict[str, str]:
    """Options of a database scan. ``connection`` (url, user, password, driver) comes from
    the caller at run time. With ``split_on`` every executor reads its own key range."""
    options = {**connection, "dbtable": table, "fetchsize": str(fetch)}
    if split_on is not None:
        if bounds is None:
            raise ValueError("a split scan needs the bounds of the split column")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return options


def scan_jdbc(spark: SparkSession, connection: Mapping[str, str], table: str, **split) -> DataFrame:
    """Database scan. Filters and column choice made on the result are pushed to the database."""
    reader: DataFrameReader = spark.read.format("jdbc")
    return reader.options(**jdbc_options(connection, table, **split)).load()


def target_schema(spark: SparkSession, table: str) -> StructType:
    """Column names and types of a report table, which drive the load casts."""
    return spark.table(table).schema


def add_partition(spark: SparkSession, table: str, column: str, value: str, location: str) -> None:
    """Register a partition that another job has written. The date is the caller's choice."""
    for text in (value, location):
        if "'" in text:
            raise ValueError(f"quote in partition text: {text!r}")
    spark.sql(
        f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({column}='{value}') LOCATION '{location}'"
    )
