"""Business rules of the advertising domain as boolean and recoding expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Enum texts of the logs.
INSTALL, EVENT = "1", "2"
CLICKED_THROUGH = "1"
SHARE_ADTYPE = "38"
MARGIN_ADTYPE = "19"
# Package tokens with rules of their own.
EXCLUDED_PACKAGE_TOKEN = "lazada"
EVENT_PAID_PACKAGE = "com.alibaba.aliexpresshd"
FEED_EXCLUDED_PACKAGE = "com.dts.freefireth"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def non_empty(*cols: str) -> Column:
    """Every column has text; NULL counts as empty."""
    test = F.lit(True)
    for c in cols:
        test = test & (_c(c) != "")
    return test


def without_token(pkg="offer_pkg", token: str = EXCLUDED_PACKAGE_TOKEN) -> Column:
    return ~F.contains(_c(pkg), F.lit(token))


def attributable(adtype="adtype", event_type="event_type", pkg="offer_pkg") -> Column:
    """Which conversion events count: by ad type in text order, with one package paid per event."""
    adtype, event_type, pkg = _c(adtype), _c(event_type), _c(pkg)
    event_paid = ((adtype < "19") | (adtype == "39")) & (event_type == EVENT)
    install_paid = (
        (adtype >= "19") & (adtype != "39") & (event_type == INSTALL) & (pkg != EVENT_PAID_PACKAGE)
    )
    return event_paid | install_paid | ((pkg == EVENT_PAID_PACKAGE) & (event_type == EVENT))


def country_code(country="country", exact: int | None = None, at_most: int | None = None) -> Column:
    size = F.length(_c(country))
    return size == exact if exact is not None else size <= at_most


def has_money(revenue="revenue", cost="cost") -> Column:
    return (_c(revenue) != 0) | (_c(cost) != 0)


def settleable(code="payee_code", cost="cost") -> Column:
    """A payee code is needed unless nothing is owed."""
    code = F.coalesce(_c(code), F.lit(""))
    return (code != "") | (_c(cost) == 0)


def platform_number(platform="platform") -> Column:
    """iOS in any case is 2, everything else 1."""
    return F.when(F.lower(_c(platform)) == "ios", F.lit(2)).otherwise(F.lit(1))


def platform_number_strict(platform, android: str) -> Column:
    """1 for exactly this spelling of Android, everything else 2."""
    return F.when(_c(platform) == android, F.lit(1)).otherwise(F.lit(2))


def platform_label(platform="platform") -> Column:
    """``android`` becomes Android, everything else iOS."""
    return F.when(_c(platform) == "android", F.lit("Android")).otherwise(F.lit("iOS"))


def platform_from_number(platform="platform") -> Column:
    """1 and 2 to labels, NULL when unknown."""
    return F.when(_c(platform) == "1", F.lit("Android")).when(_c(platform) == "2", F.lit("iOS"))


def routed_offer(adtype="adtype", offer="offer_id") -> Column:
    """Ad type 39 carries ``prefix_offer``; the second piece is the offer."""
    return F.when(_c(adtype) == "39", F.split_part(_c(offer), F.lit("_"), F.lit(2))).otherwise(_c(offer))


def any_of(col, values: Sequence[str]) -> Column:
    return _c(col).isin(list(values))


def active_cap(traffic="traffic") -> Column:
    """Sum of ``cap_daily`` over entries with ``pub_status`` 1 in a list literal.

    The text is a scripting-language literal, so its constants are rewritten before
    the JSON parse. One bad entry, or a text that is no list, makes the whole cap 0.
    """
    text = _c(traffic)
    for word, json_word in (("None", "null"), ("True", "1"), ("False", "0")):
        text = F.regexp_replace(text, rf"\b{word}\b", json_word)
    entries = F.from_json(text, "array<struct<pub_status:double,cap_daily:double>>")
    live = F.filter(entries, lambda e: e["pub_status"] == 1)
    broken = F.exists(entries, lambda e: e.isNull()) | F.exists(live, lambda e: e["cap_daily"].isNull())
    total = F.aggregate(live, F.lit(0.0), lambda acc, e: acc + e["cap_daily"])
    return F.coalesce(F.when(~F.coalesce(broken, F.lit(False)), total), F.lit(0.0)).cast("long")
