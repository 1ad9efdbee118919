"""Whole-number shares that add up to their total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adtally.operators.aggs import partition_total
from adtally.operators.ranges import running_before
from adtally.session import materialize

TEN_THOUSANDTHS = 10_000


def apportion(
    df: DataFrame, keys: Sequence[str], measure: str, order: Sequence[Column], units: int | Column = TEN_THOUSANDTHS, name: str = "share",
    ranges: int | None = None,
) -> DataFrame:
    """Add ``name``: each row's part of its group's ``units``, in proportion to ``measure`` and whole, by largest remainders.

    Every row gets its truncated part; what is left of the units goes, one each, to the rows with the largest remainders, ties by
    ``order``, which should tell the rows of a group apart. Ranks are running counts over ranges of rows, so no group is ever
    gathered. ``units`` may be a column that is equal within a group.

    A NULL measure counts as 0; a negative measure or negative units raise. A group whose measures add up to 0 has NULL shares.
    """
    units = F.lit(units) if isinstance(units, int) else units
    weight = F.coalesce(F.col(measure).cast("long"), F.lit(0))
    based = partition_total(df.withColumns({"_weight": _not_negative(weight, measure), "_units": _not_negative(units.cast("long"), "units")}), keys, {"_whole": F.sum("_weight")})
    # products of two longs need 38 digits
    product = F.col("_weight").cast("decimal(19,0)") * F.col("_units").cast("decimal(19,0)")
    based = based.withColumn("_product", product).withColumn("_base", F.when(F.col("_whole") > 0, F.col("_whole")).cast("decimal(19,0)"))
    parted = based.withColumns({"_quota": F.expr("_product div _base"), "_left": F.expr("cast(_product % _base as decimal(19,0))"), "_one": F.lit(1)})
    parted = materialize(parted.drop("_weight", "_whole", "_product", "_base"), "quotas")
    given = partition_total(parted, keys, {"_given": F.sum("_quota")})
    ranked = running_before(given, keys, [F.desc("_left"), *order], {"_ahead": "_one"}, ranges)
    share = F.col("_quota") + F.when(F.col("_ahead") < F.col("_units") - F.col("_given"), 1).otherwise(0)
    return ranked.select(*df.columns, share.alias(name))


def _not_negative(value: Column, what: str) -> Column:
    return F.when(value < 0, F.raise_error(F.lit(f"negative {what} cannot be apportioned"))).otherwise(value)
