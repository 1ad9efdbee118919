"""String helpers and key packing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pack(*parts, sep: str = "_") -> Column:
    """``a_b_c``; NULL if any part is NULL (unlike concat_ws, which would skip it)."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(_c(part).cast("string"))
    return F.concat(*pieces)


def part(x, n: int, sep: str = "_") -> Column:
    """n-th piece (from 1), empty string when absent."""
    return F.split_part(_c(x), F.lit(sep), F.lit(n))


def first_part(x, sep: str = "_") -> Column:
    return F.substring_index(_c(x), sep, 1)


def last_part(x, sep: str = "_") -> Column:
    return F.substring_index(_c(x), sep, -1)


def contains_text(needle, haystack) -> Column:
    return F.contains(_c(haystack), _c(needle))


def blank_to(x, fallback) -> Column:
    """Fallback when the value is NULL or empty."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), _c(fallback))


def slot_or_id(slot, ident) -> Column:
    return blank_to(slot, _c(ident).cast("string"))


def usable(x) -> Column:
    """NULL unless the text has at least two characters."""
    return F.when(F.length(_c(x)) > 1, _c(x))


def first_usable(*cols) -> Column:
    return F.coalesce(*[usable(c) for c in cols], F.lit(""))
