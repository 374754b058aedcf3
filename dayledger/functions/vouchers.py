"""Voucher validity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def whole_days(seconds: Column) -> Column:
    return (seconds / SECONDS_PER_DAY).cast("int")


def effective_expiry(campaign_type: Column, time_use: Column, days: Column, expire_date: Column) -> Column:
    """Type 1: the campaign's end. Type 2: use time + days, at most the campaign's end. Else null."""
    personal = time_use + F.make_dt_interval(days=days)
    known = personal.isNotNull() & expire_date.isNotNull()
    return F.when(campaign_type == 1, expire_date).when(
        (campaign_type == 2) & known, F.least(personal, expire_date)
    )


def voucher_state(
    campaign_type: Column, time_use: Column, days: Column, expire_date: Column, as_of: Column | None = None
) -> Column:
    """``expired`` / ``not_expire``; null where the rule has no answer. Default clock: query start."""
    now = F.current_timestamp() if as_of is None else as_of
    expiry = effective_expiry(campaign_type, time_use, days, expire_date)
    return F.when(expiry < now, "expired").when(expiry >= now, "not_expire")
