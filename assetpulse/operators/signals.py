"""Daily signals: each raw source reduced to one row per (asset, day).

Every reduction is a grouped aggregate, so map tasks combine before the shuffle and the shuffle key is
(asset, day): an asset that owns a third of the raw rows is spread over its days. What leaves here has
at most one row per asset and calendar day and source.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetpulse.constants import ASSET, DATE, FAILURE_CODES
from assetpulse.functions import ORDER_BITS, as_date, packed_order
from assetpulse.operators.filters import is_failure, is_pm
from assetpulse.operators.joins import restrict_to


#: A column, or a column of whole numbers from 0 up and how many bits they need.
TieBreak = str | tuple[str, int]

FIRMWARE_SOURCES = ("history", "life_events", "history_first", "life_events_first")


def row_order(tie_break: Sequence[TieBreak]) -> Column:
    """What orders the rows of a day. With a bit width for every column it is one packed number: an aggregate that picks the
    last row then keeps a hash table, with a struct of columns it has to sort the raw rows."""
    if tie_break and all(isinstance(part, tuple) for part in tie_break):
        return packed_order([(F.col(name), bits) for name, bits in tie_break])
    return F.struct(*[part if isinstance(part, str) else part[0] for part in tie_break])


def work_signal(work: DataFrame, as_of: dt.date | str, tie_break: Sequence[TieBreak]) -> DataFrame:
    """Work of the last row of each day; a null unit on an existing row counts as 0 in sums."""
    return (
        work.filter(F.col(DATE) <= as_date(as_of))
        .groupBy(ASSET, F.col(DATE).alias("day"))
        .agg(F.max_by(F.col("working_unit").cast("long"), row_order(tie_break)).alias("work"))
        .withColumn("work", F.coalesce("work", F.lit(0).cast("long")))
        .withColumn("has_work", F.lit(True))
    )


def service_signal(requests: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Preventive maintenances and failures per day."""
    category = F.col("incident_category")
    return (
        requests.filter((F.col("service_request_date") <= as_date(as_of)) & (is_pm(category) | is_failure(category)))
        .groupBy(ASSET, F.col("service_request_date").alias("day"))
        .agg(F.count_if(is_pm(category)).alias("pm"), F.count_if(is_failure(category)).alias("failure"))
    )


def code_conditions(
    code_types: Sequence[int],
    criticalities: Sequence[int],
    codes: Sequence[int],
    exclude_listed: bool = False,
) -> dict[str, Column]:
    """Output column name -> row condition, for each code type x criticality and each listed code."""
    conditions = {}
    for code_type in code_types:
        for criticality in criticalities:
            condition = (F.col("code_type") == code_type) & (F.col("criticality") == criticality)
            if exclude_listed:
                condition = condition & ~F.col("code_id").isin(list(codes))
            conditions[f"CodeType_{code_type}_criticality_{criticality}"] = condition
    for code in codes:
        conditions[f"Code_{code}"] = F.col("code_id") == code
    return conditions


def code_signal(events: DataFrame, as_of: dt.date | str, conditions: dict[str, Column]) -> DataFrame:
    """All code counts of a day in one pass over the events."""
    wanted = reduce(lambda left, right: left | right, conditions.values())
    return (
        events.filter((F.col(DATE) <= as_date(as_of)) & wanted)
        .groupBy(ASSET, F.col(DATE).alias("day"))
        .agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    )


def code_failure_signal(
    events: DataFrame, as_of: dt.date | str, codes: Sequence[int] = tuple(FAILURE_CODES)
) -> DataFrame:
    """Days with an error code that stands for a failure."""
    return (
        events.filter((F.col(DATE) <= as_date(as_of)) & F.col("code_id").isin(list(codes)))
        .groupBy(ASSET, F.col(DATE).alias("day"))
        .agg(F.count("*").alias("code_failure"))
    )


def firmware_signal(firmware: DataFrame, as_of: dt.date | str, tie_break: Sequence[TieBreak] = ()) -> DataFrame:
    """Firmware set on each day, the last of the day winning: by time, tie_break, version. The date column must be parsed
    already. If the tie-break has bit widths (or is empty), versions are whole numbers from 0 up."""
    version = F.col("firmware_version_id").cast("int")
    if all(isinstance(part, tuple) for part in tie_break):
        parts = [(micros_of_day(F.col("created_date")), 37), *[(F.col(name), bits) for name, bits in tie_break]]
        order = packed_order([*parts, (version, min(32, ORDER_BITS - sum(bits for _, bits in parts)))])
    else:
        order = F.struct("created_date", *[part if isinstance(part, str) else part[0] for part in tie_break], version)
    return (
        firmware.withColumn("day", F.col("created_date").cast("date"))
        .filter(F.col("day") <= as_date(as_of))
        .groupBy(ASSET, "day")
        .agg(F.max_by(version, order).alias("firmware"))
        .withColumn("has_firmware", F.lit(True))
    )


def micros_of_day(moment: Column) -> Column:
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60
    return seconds.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("long")


def firmware_sources(
    history: DataFrame | None, events: DataFrame | None, as_of: dt.date | str, tie_break: Sequence[TieBreak], source: str
) -> DataFrame | None:
    """Firmware of each day from the history, from life events, or from both: where both set it on a day, the one named first
    holds. None without a source of the kind asked for."""
    parts = {}
    if history is not None and source != "life_events":
        parts["history"] = firmware_signal(history, as_of, tie_break)
    if events is not None and source != "history":
        parts["life_events"] = firmware_signal(events, as_of)
    if len(parts) < 2:
        return next(iter(parts.values()), None)
    first = source.removesuffix("_first")
    ranked = [part.withColumn("rank", F.lit(int(name == first))) for name, part in parts.items()]
    both = ranked[0].unionByName(ranked[1]).groupBy(ASSET, "day").agg(F.max_by("firmware", "rank").alias("firmware"))
    return both.withColumn("has_firmware", F.lit(True))


def weekday_signal(operational_days: DataFrame, min_hours: float = 0) -> DataFrame:
    """Operating weekdays of each asset as a 7-bit mask, bit 0 for Sunday (day numbers 0 to 6, Sunday = 0)."""
    open_days = operational_days.filter(F.col("operational_hours") >= min_hours)
    bit = F.call_function("shiftleft", F.lit(1), F.col("day").cast("int"))
    return open_days.groupBy(F.col("id").alias(ASSET)).agg(F.bit_or(bit).alias("operating_weekdays"))


def install_signal(assets: DataFrame, valid: DataFrame | None = None, product: bool = True) -> DataFrame:
    """Install day of each listed asset; it also gates which assets have a timeline."""
    listed = restrict_to(assets, valid) if valid is not None else assets
    columns = [F.min("installed_date").alias("installed")]
    if product:
        columns.append(F.min_by("product_identifier", "installed_date").alias("product_identifier"))
    return listed.groupBy(ASSET).agg(*columns).withColumn("day", F.col("installed"))
