"""Schema work: typed loads, sanitised names, aligned unions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, StringType, StructType


def sanitize_names(df: DataFrame) -> DataFrame:
    """Every character that is not a word character becomes ``_``."""
    return df.toDF(*[re.sub(r"\W", "_", c) for c in df.columns])


def conform(df: DataFrame, schema: StructType, blank_strings: bool = False) -> DataFrame:
    """Select and cast to a target schema, in its order.

    Missing text stays NULL; ``blank_strings`` turns it into '' for targets that have
    no NULL. Dates accept both ``yyyyMMdd`` and ``yyyy-MM-dd`` text; other text raises, as a
    bad number does.
    """
    source = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, DateType) and isinstance(source[field.name], StringType):
            compact = F.length(col) == 8
            col = F.when(compact, F.to_date(col, "yyyyMMdd")).otherwise(F.to_date(col, "yyyy-MM-dd"))
        elif isinstance(field.dataType, StringType):
            col = col.cast("string")
            if blank_strings:
                col = F.coalesce(col, F.lit(""))
        else:
            col = col.cast(field.dataType)
        out.append(col.alias(field.name))
    return df.select(*out)


def union_all(*frames: DataFrame, missing: dict[str, object] | None = None) -> DataFrame:
    """UNION ALL by name; a column a source lacks is filled from ``missing``."""
    missing = missing or {}
    columns: list[str] = []
    for f in frames:
        columns += [c for c in f.columns if c not in columns]

    def align(f: DataFrame) -> DataFrame:
        return f.select(*[F.col(c) if c in f.columns else F.lit(missing[c]).alias(c) for c in columns])

    return reduce(lambda a, b: a.unionByName(b), [align(f) for f in frames])


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)
