"""Joins of raw rows whose keys may be hot, also as full outer joins, which the adaptive skew join leaves alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adtally.session import materialize


def hot_share(df: DataFrame) -> float:
    """Share of all rows above which a key is hot: a quarter of an average shuffle partition."""
    return 1 / (4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def large_groups(counted: DataFrame, keys: Sequence[str], share: float | None = None, rows: str = "_rows") -> DataFrame:
    """``keys, pieces`` and the other columns of the groups that hold more than ``share`` of all rows; ``pieces`` is how many
    salts bring a piece below that share.

    ``counted`` has one row per group and is read twice, so pass a written table. Fewer than ``1 / share`` groups can be
    that large, however many rows there are, so the result may be broadcast.
    """
    share = hot_share(counted) if share is None else share
    limit = (counted.agg(F.sum(rows)).first()[0] or 0) * share
    rest = [c for c in counted.columns if c not in (*keys, rows)]
    return counted.where(F.col(rows) > F.lit(limit)).select(*keys, F.ceil(F.col(rows) / F.lit(limit)).cast("int").alias("pieces"), *rest)


def _same(keys: Sequence[str], left: str, right: str, null_safe: bool = False) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])


def tag_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with the other columns of ``hot``, NULL where their key is not; no row moves."""
    tags = [F.col(f"_h.{c}") for c in hot.columns if c not in keys]
    return df.alias("_d").join(F.broadcast(hot.alias("_h")), _same(keys, "_d", "_h", null_safe=True), "left").select("_d.*", *tags)


def dealt(pieces: Column) -> Column:
    """A salt from 0 to ``pieces - 1`` by the row's place in its partition, so that equal rows are spread too."""
    return F.pmod(F.monotonically_increasing_id(), pieces).cast("int")


def salted_full_join(left: DataFrame, right: DataFrame, keys: Sequence[str], also: str | None = None, share: float | None = None) -> DataFrame:
    """Full outer join of raw rows: ``keys`` and the other columns of both sides, whose names must differ.

    A key is hot when more than ``share`` of the rows of both sides have it. The rows of a hot key on its larger side
    are dealt over salts, those on its smaller side are repeated for each salt, so a task gets a piece of the key.
    A repeated row meets some salted row of its key in another salt if not in this one, so its unmatched copies
    are dropped. NULL keys match nothing; their rows are dealt over salts on both sides and none is repeated.

    ``also`` is a further condition in SQL on ``l.column`` and ``r.column``. With it a repeated row may match
    nothing at all: such rows are found by an anti join with what matched, by all their columns, and are kept once.

    Salts follow the order of rows in a partition, so pass scans or written tables, which a lost task reads again in
    the same order.
    """
    keys = list(keys)
    both = left.select(*keys, F.lit(1).alias("_left")).unionByName(right.select(*keys, F.lit(0).alias("_left")))
    none = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = both.groupBy(*keys).agg(F.count("*").alias("_rows"), F.sum("_left").alias("_left_rows"))
    repeated = F.when(none, "none").when(F.col("_left_rows") * 2 >= F.col("_rows"), "right").otherwise("left").alias("repeated")
    counted = materialize(counted.select(*keys, "_rows", repeated), "key-counts")
    hot = large_groups(counted, keys, share)

    def salted(df: DataFrame, side: str) -> DataFrame:
        tagged = tag_hot(df, hot, keys)
        copies = F.coalesce(F.col("repeated") == side, F.lit(False))
        # dealt before it is exploded, so that the place of a row does not depend on its copies
        own = tagged.withColumn("_copy", copies).withColumn("_salt", F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(dealt(F.col("pieces"))))
        salts = F.when(F.col("_copy"), F.sequence(F.lit(0), F.col("pieces") - 1)).otherwise(F.array("_salt"))
        return own.withColumn("_salt", F.explode(salts)).drop("pieces", "repeated")

    l, r = salted(left, "left").alias("l"), salted(right, "right").alias("r")
    match = _same([*keys, "_salt"], "l", "r")
    extra = F.expr(also) if also else F.lit(True)
    rest_l, rest_r = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    merged = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys]
    lone_copy = (F.col("l._copy") & F.col("r._salt").isNull()) | (F.col("r._copy") & F.col("l._salt").isNull())
    joined = l.join(r, match & extra if also else match, "full").where(~F.coalesce(lone_copy, F.lit(False)))
    out = joined.select(*merged, *[F.col(f"l.{c}") for c in rest_l], *[F.col(f"r.{c}") for c in rest_r])
    if not also:
        return out

    def unmatched(df: DataFrame, side: str) -> DataFrame:
        """Repeated rows of a side without any match, each as often as it occurs."""
        other = "r" if side == "l" else "l"
        repeated = (l if side == "l" else r).where(F.col(f"{side}._copy"))
        met = repeated.join(r if side == "l" else l, match & extra, "left_semi").select(*[f"{side}.{c}" for c in df.columns]).distinct()
        whole = tag_hot(df, hot, keys).where(F.col("repeated") == {"l": "left", "r": "right"}[side]).select(*df.columns)
        lone = whole.alias(side).join(met.alias(other), _same(df.columns, side, other, null_safe=True), "left_anti")
        kinds = dict(out.dtypes)
        return lone.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in out.columns])

    return out.unionByName(unmatched(left, "l")).unionByName(unmatched(right, "r"))
