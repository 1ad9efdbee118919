"""JSON documents read without a fixed schema: fields are taken out of variants, and what cannot be read is set aside with the reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adtally.session import materialize

UNREADABLE, NO_LIST = "unreadable", "no list"


@dataclass(frozen=True)
class Field:
    """A column taken from ``path`` (``$.a.b[0]``) as ``kind``; without ``required`` it may be missing or null."""

    name: str
    path: str
    kind: str
    required: bool = False


def literal_json(text: Column) -> Column:
    """A scripting-language literal (single quotes, None, True, False) as JSON text."""
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        text = F.regexp_replace(text, rf"\b{word}\b", json_word)
    return F.replace(text, F.lit("'"), F.lit('"'))


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))


def _names(pairs: Sequence[tuple[Column, str]]) -> Column:
    """The names whose condition holds, NULL if none does."""
    held = F.concat_ws(", ", *[F.when(c, F.lit(n)) for c, n in pairs])
    return F.when(held != "", held)


def checked(df: DataFrame, fields: Sequence[Field], variant: str = "document", reason: str = "reason") -> DataFrame:
    """The rows with a column per field and the reason why a row cannot be read, NULL where it can.

    A document that is no JSON is unreadable; a field that is there but cannot be read as its kind has drifted; a
    required field that is absent or null is missing.
    """
    raw = {f: F.try_variant_get(F.col(variant), f.path, "variant") for f in fields}
    value = {f: F.try_variant_get(F.col(variant), f.path, f.kind) for f in fields}
    drifted = _names([(_present(raw[f]) & value[f].isNull(), f.name) for f in fields])
    missing = _names([(~_present(raw[f]), f.name) for f in fields if f.required])
    told = F.concat_ws("; ", F.concat(F.lit("drifted: "), drifted), F.concat(F.lit("missing: "), missing))
    why = F.when(F.col(variant).isNull(), F.lit(UNREADABLE)).when(told != "", told)
    return df.select(*df.columns, *[value[f].alias(f.name) for f in fields], why.alias(reason))


def read_documents(df: DataFrame, text: str, fields: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """(rows with the fields, rejected rows with the text and the reason) of a text column of JSON; every row is in one of them.

    The documents are parsed once; both outputs read the written result.
    """
    keep = [c for c in df.columns if c != text]
    told = checked(df.withColumn("document", F.try_parse_json(F.col(text))), fields)
    # the text of a readable row is not kept
    slim = told.select(*keep, F.when(F.col("reason").isNotNull(), F.col(text)).alias(text), *[f.name for f in fields], "reason")
    stored = materialize(slim, "documents")
    good = stored.where("reason IS NULL").select(*keep, *[f.name for f in fields])
    return good, stored.where("reason IS NOT NULL").select(*keep, text, "reason")


def read_entries(df: DataFrame, text: str, path: str, fields: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """(a row per entry of the list at ``path``, rejected documents and entries with the reason). ``entry`` is the place in
    the list, NULL where a whole document is rejected. An empty list has no row in either."""
    keep = [c for c in df.columns if c != text]
    listed = F.try_variant_get(F.try_parse_json(F.col(text)), path, "array<variant>")
    spread = df.select(*df.columns, F.try_parse_json(F.col(text)).isNull().alias("_broken"), listed.alias("_list"))
    entries = spread.select(*keep, text, "_broken", F.col("_list").isNull().alias("_none"), F.posexplode_outer("_list").alias("entry", "document"))
    # an empty list explodes to a row without a place, like a missing one
    entries = entries.where(F.col("entry").isNotNull() | F.col("_none"))
    told = checked(entries, fields)
    why = F.when(F.col("_broken"), F.lit(UNREADABLE)).when(F.col("_none"), F.lit(NO_LIST)).otherwise(F.col("reason")).alias("reason")
    shown = F.when(F.col("entry").isNull(), F.col(text)).otherwise(F.to_json("document"))
    slim = told.select(*keep, "entry", F.when(F.col("reason").isNotNull() | F.col("_none"), shown).alias(text), *[f.name for f in fields], why)
    stored = materialize(slim, "entries")
    good = stored.where("reason IS NULL").select(*keep, "entry", *[f.name for f in fields])
    return good, stored.where("reason IS NOT NULL").select(*keep, "entry", text, "reason")


def observed_schema(df: DataFrame, text: str) -> str:
    """The schema that the readable documents of a text column have in common, as seen today; one row leaves the cluster."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(text)))).first()[0]
