"""As-of join: rows meet the version of a dimension that was in force at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from adtally.operators.skew import dealt, large_groups, tag_hot
from adtally.session import materialize

HOUR = 3600
ALWAYS = "0001-01-01 00:00:00"


def always(dimension: DataFrame, valid_from: str = "valid_from") -> DataFrame:
    """A dimension without versions: what it holds has been in force for ever."""
    return dimension.withColumn(valid_from, F.lit(ALWAYS).cast("timestamp"))


def bucket_of(at: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(seconds * 1_000_000))


def _named(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"_k{i}") for i, c in enumerate(names)]


def asof_join(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, valid_from: str = "valid_from",
    seconds: int = 24 * HOUR, share: float | None = None,
) -> DataFrame:
    """Every row of ``facts`` with the columns of the version of its key that has the latest ``valid_from`` not after ``at``,
    or NULL where there is none.

    A version holds until the next one of its key. Of versions with one key and time the largest by its other
    columns holds. A row whose key or time is NULL meets nothing; a version whose key or time is NULL is never met.

    Facts and versions are put in one table and the last version is carried down to the facts behind it, so a fact is
    shuffled once and never multiplied. A key is cut into buckets of ``seconds``, and each bucket begins with the
    version in force at its start, found on versions and counted buckets alone. A bucket that holds more than
    ``share`` of all facts is dealt over salts with its versions repeated, so one key, or one moment, may hold any share
    of the rows. Pass facts that are a scan or a written table (see ``skew.salted_full_join``).
    """
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    held = [c for c in versions.columns if c not in (*keys, valid_from)]
    clash = set(held) & set(facts.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = versions.dropna(subset=[*keys, valid_from]).groupBy(*_named(versions, keys), F.col(valid_from).alias("_t"))
    known = known.agg(F.max(F.struct(*held) if held else F.struct(F.lit(1).alias("_one"))).alias("_v")).withColumn("_bucket", bucket_of(F.col("_t"), seconds))

    placed = facts.select(F.struct(*facts.columns).alias("_fact"), *_named(facts, keys), F.col(at).cast("timestamp").alias("_t"))
    placed = placed.withColumn("_bucket", bucket_of(F.col("_t"), seconds))
    group = [*names, "_bucket"]

    # one row per key and bucket with facts or versions; each is told what held when it began
    seen = placed.groupBy(*group).agg(F.count("*").alias("_rows"))
    last = known.groupBy(*group).agg(F.max(F.struct("_t", "_v")).alias("_last"))
    steps = seen.withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType)).unionByName(last.withColumn("_rows", F.lit(None).cast("long")))
    steps = steps.groupBy(*group).agg(F.sum("_rows").alias("_rows"), F.max("_last").alias("_last"))
    before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.last("_last", ignorenulls=True).over(before).alias("_carried")
    begun = materialize(steps.select(*group, "_rows", carry).where("_rows IS NOT NULL"), "asof-buckets")
    hot = large_groups(begun.select(*group, "_rows"), group, share)

    nothing = F.lit(None).cast(placed.schema["_fact"].dataType)
    inside = known.join(begun.select(*group), group, "left_semi").select(*group, "_t", F.lit(1).alias("_rank"), "_v", nothing.alias("_fact"))
    carried = begun.where("_carried IS NOT NULL").select(
        *group, F.col("_carried._t").alias("_t"), F.lit(0).alias("_rank"), F.col("_carried._v").alias("_v"), nothing.alias("_fact")
    )
    repeated = tag_hot(inside.unionByName(carried), hot, group)
    salts = F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1)
    repeated = repeated.withColumn("_salt", F.explode(salts)).drop("pieces")
    own = tag_hot(placed, hot, group).withColumn("_salt", F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(dealt(F.col("pieces"))))
    own = own.select(*group, "_t", F.lit(2).alias("_rank"), F.lit(None).cast(known.schema["_v"].dataType).alias("_v"), "_fact", "_salt")

    down = Window.partitionBy(*group, "_salt").orderBy("_t", "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = own.unionByName(repeated).withColumn("_held", F.last("_v", ignorenulls=True).over(down)).where("_rank = 2")
    # NULL keys form groups here but meet no version, and a NULL time sorts first
    return met.select("_fact.*", *[F.col(f"_held.{c}").alias(c) for c in held])


def enrich_asof(facts: DataFrame, at: str, *dims: tuple[DataFrame, Sequence[str]], valid_from: str = "valid_from", **how) -> DataFrame:
    """Star join as of ``at``: each (versions, keys) in turn. A dimension without ``valid_from`` is joined as it is, which
    Spark may broadcast. What one step made is written before the next as-of step deals it over salts."""
    rows = facts
    for versions, keys in dims:
        if valid_from in versions.columns:
            rows = asof_join(rows if rows is facts else materialize(rows, "asof-rows"), versions, keys, at, valid_from, **how)
        else:
            rows = rows.join(versions, list(keys), "left")
    return rows
