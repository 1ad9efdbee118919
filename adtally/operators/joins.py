"""Equi-joins of aggregated sides.

Three rules hold everywhere:

* Logs are aggregated before they meet anything. The partial aggregate runs in the scan's
  own stage, so a hot key is combined on every executor before the shuffle.
* Sides that share the full grain are aggregated on the join keys and then joined. The join
  reuses the aggregates' partitioning, so it adds no shuffle, and every key is one row per
  side, so it cannot skew, not even as a full outer join.
* No broadcast is forced on data whose size is not known to be one row. Spark broadcasts a
  side when its measured size is below ``spark.sql.autoBroadcastJoinThreshold``, and beyond
  that shuffles it; a partition swollen by a hot key is then split by the adaptive skew join
  (see ``session.SETTINGS``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def merge_sums(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "full") -> DataFrame:
    """Join two logs on their common grain while summing every measure.

    ``left`` and ``right`` carry the keys plus distinct measure columns and need not be
    aggregated. A measure is NULL where its side has no row; NULL keys match nothing.
    """

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in df.columns if c not in keys])

    return summed(left).join(summed(right), list(keys), how)


def join_defaults(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    defaults: Mapping[str, object],
) -> DataFrame:
    """Outer join whose unmatched right columns take type defaults instead of NULL."""
    return left.join(right, list(keys), how).na.fill(dict(defaults), subset=list(defaults))


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with one set of keys; also replaces RIGHT JOIN UNION LEFT JOIN."""
    return left.join(right, list(keys), "full")


def attach_total(df: DataFrame, totals: DataFrame, keys: Sequence[str], salts: int = 1) -> DataFrame:
    """Left join per-key totals (or a few rows per key) onto rows whose key may be hot.

    NULL keys form a group of their own, as they do in a window. Small totals are broadcast
    by Spark's size check and the rows stay where they are; otherwise the adaptive skew join
    splits a hot key's rows over tasks. ``salts`` spreads every key over that many tasks by
    a hash of the row instead, for sessions that run without adaptive execution.
    """
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    side = totals.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    if salts > 1:
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
        side = side.withColumn("_t_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        match = match & (F.col("_salt") == F.col("_t_salt"))
    return df.join(side, match, "left").drop("_salt", "_t_salt", *[f"_t_{k}" for k in keys])


def enrich(df: DataFrame, *dims: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Star join: left join each (dimension, keys) in turn."""
    return reduce(lambda acc, d: acc.join(d[0], list(d[1]), "left"), dims, df)


def inner_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner merge. Rows with NULL keys are dropped, where a data-frame merge would pair them."""
    return left.join(right, list(keys), "inner")


def keep_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Semi join: the IN list stays a table and is never collected."""
    return df.join(listed.select(*keys), list(keys), "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(listed.select(*keys), list(keys), "left_anti")


def flag_join(df: DataFrame, flags: DataFrame, keys: Sequence[str], flag: str, default) -> DataFrame:
    """Left join a status and fill only that column."""
    return df.join(flags, list(keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(default)))


def pair_single_rows(*rows: DataFrame) -> DataFrame:
    """Put single-row aggregates side by side on a constant key; the first row survives.

    A frame with more rows is refused while it runs, instead of pairing all of them.
    """
    tagged = []
    for r in rows:
        whole = r.agg(F.collect_list(F.struct(*r.columns)).alias("_r"))
        alone = F.when(F.size("_r") <= 1, F.col("_r")).otherwise(F.raise_error(F.lit("more than one row to put side by side")))
        tagged.append(whole.select(F.lit("a").alias("_one"), F.inline_outer(alone)))
    return reduce(lambda a, b: a.join(b, "_one", "left"), tagged).drop("_one")
