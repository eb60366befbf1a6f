"""Status intervals out of events, and tests that hold for every day of a span.

A status holds from its event up to the day before the next one. A test over every day is then a test over the intervals
that meet the span: no calendar is built, and an asset has at most one interval per day with events, however many it has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetpulse.constants import ASSET, DATE, LOG_DAILY, LOG_EVENT
from assetpulse.functions import as_date
from assetpulse.operators.filters import installed_after, old_enough


def status_intervals(life_events: DataFrame, code: int, wanted: int, as_of: dt.date | str) -> DataFrame:
    """(asset, from_day, until_day, ok): closed spans of the status that the events of one code set, up to as_of.

    Of several events of a day all must have the wanted value for ok; a null value is another value. Events without a date
    are left out. Events are reduced per (asset, day) before the shuffle."""
    daily = (
        life_events.filter((F.col("life_event_code").cast("int") == code) & (F.col(DATE) <= as_date(as_of)))
        .groupBy(ASSET, F.col(DATE).alias("from_day"))
        .agg(F.min(F.col("life_event_value").cast("int").eqNullSafe(wanted)).alias("ok"))
    )
    following = F.lead("from_day").over(Window.partitionBy(ASSET).orderBy("from_day"))
    until = F.coalesce(F.date_sub(following, 1), as_date(as_of))
    return daily.select(ASSET, "from_day", until.alias("until_day"), "ok")


def holds_throughout(spans: DataFrame, intervals: DataFrame, output: str) -> DataFrame:
    """spans(asset, first_day, last_day) with output 1 where every day of the span lies in an ok interval, else 0.

    Intervals of an asset follow each other without a gap, so the span is covered if one of them has begun by its first
    day; an interval that is not ok may not meet it."""
    meets = (F.col("from_day") <= F.col("last_day")) & (F.col("until_day") >= F.col("first_day"))
    tested = spans.join(intervals, ASSET, "left").groupBy(ASSET, "first_day", "last_day").agg(
        F.max(F.col("from_day") <= F.col("first_day")).alias("begun"), F.max(meets & ~F.col("ok")).alias("broken")
    )
    whole = F.coalesce(F.col("begun"), F.lit(False)) & ~F.coalesce(F.col("broken"), F.lit(False))
    return tested.select(ASSET, "first_day", "last_day", whole.cast("int").alias(output))


def log_status_throughout(
    life_events: DataFrame, work: DataFrame, as_of: dt.date | str, wanted: int = LOG_DAILY
) -> DataFrame:
    """Per asset with work: its first work day, as_of, and whether the log status was `wanted` on every day between."""
    spans = work.filter(F.col(DATE) <= as_date(as_of)).groupBy(ASSET).agg(F.min(DATE).alias("first_day"))
    spans = spans.withColumn("last_day", as_date(as_of))
    return holds_throughout(spans, status_intervals(life_events, LOG_EVENT, wanted, as_of), "log_throughout")


def eligible_assets(
    assets: DataFrame,
    work: DataFrame,
    life_events: DataFrame,
    as_of: dt.date | str,
    after: dt.date | str | None = "2010-12-31",
    min_age_days: int | None = 90,
    min_days: int | None = 60,
    log_status: int | None = LOG_DAILY,
) -> DataFrame:
    """Ids of the assets installed after a day and at least min_age_days before as_of, with work on min_days days or more up to
    as_of, whose log status was log_status throughout. None leaves a condition out."""
    listed = assets
    if after is not None:
        listed = installed_after(listed, after)
    if min_age_days is not None:
        listed = old_enough(listed, as_of, min_age_days)
    ids = listed.select(ASSET).distinct()
    if min_days is not None:
        days = work.filter(F.col(DATE) <= as_date(as_of)).select(ASSET, DATE).distinct().groupBy(ASSET).count()
        ids = ids.join(days.filter(F.col("count") >= min_days), ASSET, "left_semi")
    if log_status is not None:
        whole = log_status_throughout(life_events, work, as_of, log_status).filter("log_throughout = 1")
        ids = ids.join(whole, ASSET, "left_semi")
    return ids.select(F.col(ASSET).alias("id"))
