"""Column lists and types of dimensions and report tables."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# The columns of the offer and stream-offer dimensions.
OFFER_SOURCE = [
    "id", "offer_id", "adv_offer", "create_type", "channel", "channel_type", "adv_status", "conversion_flow",
    "status", "title", "pkg", "attribute_provider", "pid", "platform", "country", "revenue", "adtype",
    "adv_tracking_link", "target_cvr", "cvr_status", "is_s2s", "s2s_tracking_link", "app_url", "site_type",
    "site_value", "site_black_value", "description", "traffic",
]
STREAM_OFFER_SOURCE = [
    "id", "channel", "offer_id", "attribute_provider", "title", "tracking_link", "pid", "pkg_name", "payout",
    "platform", "country", "max_clk_num", "device", "site_id", "hour", "clk_id", "site_clk_limit",
    "site_clk_id", "category_id", "site_install_limitation", "conversion_flow", "event_name", "status",
    "diy_siteid", "note", "start_hour", "end_hour",
]
OFFER_LONGS = {"cap_daily", "create_type", "channel_type", "adv_status", "status", "cvr_status", "is_s2s"}
OFFER_DOUBLES = {"revenue", "target_cvr"}
STREAM_LONGS = {"id", "max_clk_num", "status"}
STREAM_DOUBLES = {"payout"}


def _typed(names: list[str], longs: set[str], doubles: set[str]) -> StructType:
    kinds = {**dict.fromkeys(longs, LongType()), **dict.fromkeys(doubles, DoubleType())}
    return StructType([StructField(n, kinds.get(n, StringType())) for n in names])


_after_type = OFFER_SOURCE.index("channel_type") + 1
OFFER_TARGET = _typed(
    [n for n in [*OFFER_SOURCE[:_after_type], "cap_daily", *OFFER_SOURCE[_after_type:]] if n != "id"],
    OFFER_LONGS,
    OFFER_DOUBLES,
)
STREAM_OFFER_TARGET = _typed(
    [{"pkg_name": "offer_pkg", "site_id": "siteid_type", "hour": "siteid_hour"}.get(n, n) for n in STREAM_OFFER_SOURCE],
    STREAM_LONGS,
    STREAM_DOUBLES,
)
