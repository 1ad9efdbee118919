"""Keyed snapshots: insert-or-replace by key without a MERGE-capable table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adtally.functions.text import pack
from adtally.operators.aggs import first_by
from adtally.session import replace_folder, staged


def merged(current: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Current rows overlaid with updates, one row per key.

    Updates win over stored rows; among updates of one key the smallest by ``order``
    (then by the remaining columns) wins, so a rerun gives the same table. One
    aggregation instead of a full outer join.
    """
    updates = updates.select(*current.columns)
    both = updates.withColumn("_age", F.lit(0)).unionByName(current.withColumn("_age", F.lit(1)))
    return first_by(both, keys, [F.col("_age"), *order]).drop("_age")


def replace_rows(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    partition_by: str | None = None,
) -> None:
    """Replace rows by (compound) key in the parquet snapshot at ``path``.

    With ``partition_by`` (one of the keys) only the partitions that have updates are read,
    by dynamic partition pruning, and rewritten, so the cost follows the update and not the
    history. The merged rows are computed and staged first, and partitions or the whole folder are
    swapped when their files are complete, so a failed run leaves the old rows readable.
    """
    current = spark.read.schema(updates.schema).parquet(path)
    if partition_by:
        current = current.join(updates.select(partition_by).distinct(), partition_by, "left_semi")
    with staged(merged(current, updates, keys, order), "snapshot") as rows:
        if partition_by:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
        else:
            replace_folder(rows, path)


def upsert_kv(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    order: Sequence[Column] = (),
    partition_by: str | None = None,
) -> None:
    """Insert-or-update on ``key``, per partition if the snapshot is partitioned."""
    keys = ["key"] if partition_by is None else [partition_by, "key"]
    replace_rows(spark, updates, path, keys, order, partition_by)


def snapshot_kv(df: DataFrame, value: Column, *key_parts) -> DataFrame:
    """(key, value) text pairs; rows without a key or value are left out."""
    pairs = df.select(pack(*key_parts).alias("key"), value.cast("string").alias("value"))
    return pairs.na.drop()


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Existing rows take the source's values where it has them; no row is added."""
    fresh = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols])
    out = target.join(fresh, list(keys), "left")
    return out.select(
        *[
            F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
            for c in target.columns
        ]
    )
