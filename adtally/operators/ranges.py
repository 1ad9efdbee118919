"""Running sums within groups of any size, by ranges of rows instead of whole-group windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from adtally.session import materialize


def running_before(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Mapping[str, str], ranges: int | None = None) -> DataFrame:
    """Add, for each new name, the sum of a whole-number column over the rows that come before in the row's group; 0 for the first.

    Rows are dealt over ``ranges`` (shuffle partitions, unless given) by group and order and written once, so a group
    with a third of all rows is spread over a third of the ranges. Sums per group and range are added up over the ranges; what came
    before a range then heads its rows as a row of its own, and a window goes over one group in one range at most. ``order``
    should tell the rows of a group apart: rows it cannot tell apart lie in one range, in any order. NULL keys form a group,
    NULL values count as 0.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = {name: F.coalesce(F.col(c).cast("long"), F.lit(0)) for name, c in sums.items()}
    dealt = df.repartitionByRange(n, *keys, *order).withColumn("_bucket", F.spark_partition_id())
    rows = materialize(dealt, "ranges")
    parts = rows.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(f"_own_{name}") for name, v in values.items()])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    kept = [*keys, "_bucket"]
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name not in kept]
    heads = parts.select(
        *kept, F.lit(0).alias("_place"), *[F.coalesce(F.sum(f"_own_{name}").over(earlier), F.lit(0)).alias(f"_val_{name}") for name in values], *rest
    )
    tails = rows.select(*kept, F.lit(1).alias("_place"), *[v.alias(f"_val_{name}") for name, v in values.items()], *[f.name for f in rows.schema.fields if f.name not in kept])
    inside = Window.partitionBy(*kept).orderBy("_place", *order).rowsBetween(Window.unboundedPreceding, -1)
    run = heads.unionByName(tails).select("*", *[F.sum(f"_val_{name}").over(inside).alias(name) for name in values])
    return run.where("_place = 1").select(*df.columns, *values)
