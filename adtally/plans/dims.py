"""Dimension refreshes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adtally.functions import rules
from adtally.operators.shape import conform, pick, rename
from adtally.schemas import OFFER_SOURCE, OFFER_TARGET, STREAM_OFFER_SOURCE, STREAM_OFFER_TARGET

STREAM_RENAMES = {"pkg_name": "offer_pkg", "site_id": "siteid_type", "hour": "siteid_hour"}


def offer_dimension(offers: DataFrame) -> DataFrame:
    """Offers with the daily cap of their active traffic entries; the listing id is dropped."""
    return conform(
        pick(offers, OFFER_SOURCE).withColumn("cap_daily", rules.active_cap()).drop("id"),
        OFFER_TARGET,
        blank_strings=True,
    )


def stream_offer_dimension(stream_offers: DataFrame) -> DataFrame:
    """A 27-column copy with three renamed columns."""
    return conform(
        rename(pick(stream_offers, STREAM_OFFER_SOURCE), STREAM_RENAMES), STREAM_OFFER_TARGET, blank_strings=True
    )
