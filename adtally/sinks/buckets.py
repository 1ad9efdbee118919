"""Keyed snapshots in buckets: a load reads and rewrites only the buckets its keys fall into.

Rows lie in folders ``bucket=k`` by a hash of ``by``, columns or expressions of the key. Keys that change together should share
it, as the counters of one day or offer do; then a load of few of them touches few buckets, however long the history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from adtally.session import staged
from adtally.sinks import keyed

BUCKET = "bucket"
LAYOUT = "_layout"  # readers of the snapshot skip names with this mark


def bucket_of(by: Sequence[str | Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str) -> None:
    """Swap the buckets that ``rows`` hold, each when its files are complete; a bucket with most rows is split over tasks."""
    (
        rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET).parquet(path)
    )


def create_buckets(df: DataFrame, path: str, buckets: int, by: Sequence[str | Column]) -> None:
    """A new snapshot; the number of buckets is kept beside it, so that later loads cannot use another one."""
    df.sparkSession.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/{LAYOUT}")
    _write(df.withColumn(BUCKET, bucket_of(by, buckets)), path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, touched: Sequence[int] | None = None) -> DataFrame:
    """The rows with their ``bucket``; ``touched`` keeps other folders from being listed or read."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    return rows if touched is None else rows.where(F.col(BUCKET).isin(list(touched)))


def update_buckets(
    updates: DataFrame, path: str, by: Sequence[str | Column], merge: Callable[[DataFrame, DataFrame], DataFrame], schema: T.StructType | None = None
) -> list[int]:
    """Put ``merge(current, updates)`` in place of the touched buckets and return their numbers.

    ``merge`` gets the rows of these buckets alone, with their ``bucket``, keeps it, and may change and add rows but not empty a bucket.
    Updates and merged rows are staged before any bucket is swapped. ``schema`` is that of the stored rows, if it differs from the updates'.
    """
    spark = updates.sparkSession
    buckets = spark.read.schema("buckets int").parquet(f"{path}/{LAYOUT}").first()[0]
    with staged(updates.withColumn(BUCKET, bucket_of(by, buckets)), "updates") as fresh:
        # at most one number per bucket
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        if touched:
            current = read_buckets(spark, path, schema or updates.schema, touched)
            with staged(merge(current, fresh), "buckets") as rows:
                _write(rows, path)
    return touched


def upsert_buckets(updates: DataFrame, path: str, keys: Sequence[str], by: Sequence[str | Column], order: Sequence[Column] = ()) -> list[int]:
    """Insert or replace by key, as ``keyed.replace_rows`` does on a whole snapshot."""
    return update_buckets(updates, path, by, lambda current, fresh: keyed.merged(current, fresh, [BUCKET, *keys], order))


def update_buckets_from(source: DataFrame, path: str, keys: Sequence[str], cols: Sequence[str], by: Sequence[str | Column], schema: T.StructType) -> list[int]:
    """Existing rows take the source's values where it has them, as with ``keyed.update_from``; no row is added."""
    return update_buckets(source, path, by, lambda current, fresh: keyed.update_from(current, fresh, [BUCKET, *keys], cols), schema)
