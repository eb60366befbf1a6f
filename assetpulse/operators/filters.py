"""Row filters and constant columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetpulse.constants import ASSET, FIRMWARE_EVENT, NON_FAILURE_CATEGORIES, PM_CATEGORY
from assetpulse.functions import as_date


def status_is(df: DataFrame, value: str, column: str = "active_status") -> DataFrame:
    return df.filter(F.col(column) == value)


def status_not(df: DataFrame, value: str, column: str = "active_status") -> DataFrame:
    """Rows whose value differs; null counts as different."""
    return df.filter(~F.col(column).eqNullSafe(value))


def unknown_status(assets: DataFrame) -> DataFrame:
    """Assets neither Active nor Inactive; a null status is not listed, as in SQL NOT IN."""
    return assets.filter(~F.col("active_status").isin("Active", "Inactive"))


def is_pm(category: Column) -> Column:
    return category == PM_CATEGORY


def is_failure(category: Column) -> Column:
    """A request with a known category outside the non-failure list."""
    return category.isNotNull() & ~category.isin(NON_FAILURE_CATEGORIES)


def pm_requests(requests: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    return between_dates(requests.filter(is_pm(F.col("incident_category"))), first, last, "service_request_date")


def failure_requests(requests: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    return between_dates(requests.filter(is_failure(F.col("incident_category"))), first, last, "service_request_date")


def between_dates(df: DataFrame, first: dt.date | str, last: dt.date | str, column: str = "date") -> DataFrame:
    """Closed date range."""
    return df.filter(F.col(column).between(as_date(first), as_date(last)))


def life_events_where(life_events: DataFrame, code: int, value: int) -> DataFrame:
    return life_events.filter(
        (F.col("life_event_code").cast("int") == code) & (F.col("life_event_value").cast("int") == value)
    )


def firmware_from_life_events(
    life_events: DataFrame, type_column: str, version_column: str
) -> DataFrame:
    """Firmware history out of a generic life-event table: rows of the firmware type, renamed."""
    return life_events.filter(F.col(type_column).cast("int") == FIRMWARE_EVENT).select(
        ASSET,
        F.col(version_column).cast("int").alias("firmware_version_id"),
        F.col("date").cast("string").alias("created_date"),
    )


def old_enough(assets: DataFrame, as_of: dt.date | str, min_age_days: int = 90) -> DataFrame:
    """Assets installed more than min_age_days before as_of."""
    return assets.filter(F.col("installed_date") < F.date_sub(as_date(as_of), min_age_days))


def installed_after(assets: DataFrame, day: dt.date | str = "2010-12-31") -> DataFrame:
    return assets.filter(F.col("installed_date") > as_date(day))


def with_const(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def keep_last(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest tie-break tuple.

    An aggregate instead of a ranking window, so duplicates are reduced before the shuffle and a key
    with very many rows costs one row per map task.
    """
    rest = [column for column in df.columns if column not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*tie_break)).alias("kept")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"kept.{column}").alias(column) for column in rest])
