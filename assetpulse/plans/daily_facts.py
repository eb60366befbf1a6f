"""Daily fact table: one row per asset and day with work, maintenance, failure, firmware, code and device columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetpulse.constants import (
    ASSET,
    CHANGE_COLUMNS,
    CHANGE_DISTANCE,
    CODE_TYPES,
    CRITICALITIES,
    DATE,
    DEVICE_COLUMNS,
    FAILURE_CODES,
    LISTED_CODES,
)
from assetpulse.functions import as_date, euclidean, operating_days_between
from assetpulse.operators import signals as sig
from assetpulse.operators import timeline as tl
from assetpulse.operators.joins import first_per_key

WORK_COLUMNS = ["notes_in", "notes_in_last30", "age", "Avg_notes_in", "Avg_notes_in_last30"]
SERVICE_COLUMNS = [
    "notes_in_last_pm",
    "last_pm_date",
    "day_to_failure",
    "numIncidents",
    "days_Since_failure",
]


@dataclass(frozen=True)
class FactSettings:
    """Options of the fact table; the defaults are the standard table.

    first_date and last_date limit the days returned, not the history they are computed from. partitions is the number of
    tasks that hold the reduced signals of assets; by default the session's number of shuffle partitions.
    """

    window_days: int = 30
    horizon_days: int = 30
    cap_days: int = 180
    pm_scope: str = "from_install"
    failure_label: str = "requests"
    code_types: Sequence[int] = field(default_factory=lambda: tuple(CODE_TYPES))
    criticalities: Sequence[int] = field(default_factory=lambda: tuple(CRITICALITIES))
    codes: Sequence[int] = field(default_factory=lambda: tuple(LISTED_CODES))
    exclude_listed_codes: bool = False
    failure_codes: Sequence[int] = field(default_factory=lambda: tuple(FAILURE_CODES))
    device_columns: str | None = "features"
    firmware_source: str = "history"
    min_hours: float = 0
    partitions: int | None = None
    first_date: dt.date | str | None = None
    last_date: dt.date | str | None = None

    def __post_init__(self):
        if self.device_columns not in ("features", "master", None):
            raise ValueError("device_columns is 'features', 'master' or None")
        if self.firmware_source not in sig.FIRMWARE_SOURCES:
            raise ValueError(f"firmware_source is one of {sig.FIRMWARE_SOURCES}")


@dataclass(frozen=True)
class FactSources:
    """Inputs of the fact table. A source left out takes its columns out of the result.

    firmware_events is firmware out of life events (filters.firmware_from_life_events). error_events must have been cleared of rows with nulls, and firmware.created_date be parsed
    (sources.drop_any_null, sources.valid_dates).
    """

    work: DataFrame
    assets: DataFrame
    work_tie_break: Sequence[str]
    valid: DataFrame | None = None
    service_requests: DataFrame | None = None
    error_events: DataFrame | None = None
    firmware: DataFrame | None = None
    firmware_tie_break: Sequence[str] = ()
    firmware_events: DataFrame | None = None
    asset_features: DataFrame | None = None
    operational_days: DataFrame | None = None


@dataclass(frozen=True)
class Timeline:
    """States of the assets, and what is needed to expand them to fact rows."""

    states: DataFrame
    line: tl.TimelineSettings
    settings: FactSettings
    names: list[str]
    device: list[str]

    def options(self) -> dict[str, object]:
        return {
            "horizon_days": self.settings.horizon_days,
            "cap_days": self.settings.cap_days,
            "failure_label": self.settings.failure_label,
        }

    def days(self, states: DataFrame) -> DataFrame:
        return tl.expand_days(states, self.settings.first_date, self.settings.last_date)


def timeline(sources: FactSources, as_of: dt.date | str, settings: FactSettings | None = None) -> Timeline:
    """Signals, change days and states; all shuffles and joins are below the states."""
    settings = settings or FactSettings()
    by_product = settings.device_columns == "features" and sources.asset_features is not None
    stack = [
        sig.install_signal(sources.assets, sources.valid, product=by_product),
        sig.work_signal(sources.work, as_of, sources.work_tie_break),
    ]
    attributes = ["product_identifier"] if by_product else []
    names = list(WORK_COLUMNS)
    code_columns: list[str] = []
    if sources.operational_days is not None:
        stack.append(sig.weekday_signal(sources.operational_days, settings.min_hours))
        attributes.append(tl.OPERATING_WEEKDAYS)
        names.append("operational_age")
    if sources.service_requests is not None:
        stack.append(sig.service_signal(sources.service_requests, as_of))
        names += SERVICE_COLUMNS
    label_known = sources.service_requests is not None
    if sources.error_events is not None:
        conditions = sig.code_conditions(
            settings.code_types, settings.criticalities, settings.codes, settings.exclude_listed_codes
        )
        code_columns = list(conditions)
        if conditions:
            stack.append(sig.code_signal(sources.error_events, as_of, conditions))
    if settings.failure_label == "error_codes":
        if sources.error_events is None:
            raise ValueError("failure_label='error_codes' needs error_events")
        stack.append(sig.code_failure_signal(sources.error_events, as_of, settings.failure_codes))
        label_known = True
    if label_known:
        names.append("failure_event")
    firmware = sig.firmware_sources(
        sources.firmware, sources.firmware_events, as_of, sources.firmware_tie_break, settings.firmware_source
    )
    if firmware is not None:
        stack.append(firmware)
        names.append("firmwareHistory")

    line = tl.TimelineSettings(
        as_of=as_of,
        window_days=settings.window_days,
        pm_scope=settings.pm_scope,
        attributes=tuple(attributes),
        partitions=settings.partitions,
        code_columns=tuple(code_columns),
    )
    bounded = tl.with_bounds(tl.stack_signals(stack, line), line)
    states = tl.asset_states(tl.change_days(bounded, line), line)
    device: list[str] = []
    if by_product:
        device = [name for name in DEVICE_COLUMNS if name in sources.asset_features.columns]
        states = states.join(first_per_key(sources.asset_features, "product_identifier", device), "product_identifier")
    elif settings.device_columns == "master":
        device = [name for name in DEVICE_COLUMNS if name in sources.assets.columns]
        states = states.join(first_per_key(sources.assets, ASSET, device), ASSET)
    for name in code_columns:
        names += [name, f"{name}_std"]
    return Timeline(states, line, settings, names, device)


def daily_facts(sources: FactSources, as_of: dt.date | str, settings: FactSettings | None = None) -> DataFrame:
    line = timeline(sources, as_of, settings)
    columns = tl.fact_columns(line.line, **line.options())
    return line.days(line.states).select(ASSET, DATE, *[columns[name].alias(name) for name in line.names], *line.device)


def daily_change(
    sources: FactSources,
    as_of: dt.date | str,
    settings: FactSettings | None = None,
    columns: Sequence[str] = tuple(CHANGE_COLUMNS),
    threshold: float = CHANGE_DISTANCE,
) -> DataFrame:
    """row_change of the fact table, without a dense window: the previous row is arithmetic on the state that held a day
    earlier, which is the row's own or the one before it. Any fact columns may be compared."""
    line = timeline(sources, as_of, settings)
    days = line.days(tl.with_previous(line.states))
    now = tl.fact_columns(line.line, **line.options())
    before = tl.previous_fact_columns(line.line, **line.options())
    first = (F.col(DATE) == F.col("day")) & F.col("before_day").isNull()
    distance = F.when(~first, euclidean([(now[name], before[name]) for name in columns]))
    return with_changed(days.select(ASSET, DATE, distance.alias("distance")), threshold)


def daily_work_panel(sources: FactSources, as_of: dt.date | str, window_days: int = 30) -> DataFrame:
    """Dense work calendar: the day's work (0 on absent days), its running sum and its rolling sum."""
    line = tl.TimelineSettings(as_of=as_of, window_days=window_days)
    stack = [
        sig.install_signal(sources.assets, sources.valid, product=False),
        sig.work_signal(sources.work, as_of, sources.work_tie_break),
    ]
    states = tl.asset_states(tl.change_days(tl.with_bounds(tl.stack_signals(stack, line), line), line), line)
    columns = tl.fact_columns(line)
    wanted = ["working_unit", "notes_in", "notes_in_last30", "age"]
    return tl.expand_days(states).select(ASSET, DATE, *[columns[name].alias(name) for name in wanted])


def dropped_assets(sources: FactSources, as_of: dt.date | str) -> DataFrame:
    """Listed assets that get no fact rows, each with the first cause that applies."""
    if sources.valid is None:
        raise ValueError("dropped_assets needs the valid list")
    listed = sources.valid.select(F.col(sources.valid.columns[0]).alias(ASSET)).distinct()
    first_work = (
        sources.work.filter(F.col(DATE) <= as_date(as_of)).groupBy(ASSET).agg(F.min(DATE).alias("first_work"))
    )
    master = sig.install_signal(sources.assets).select(ASSET, "installed", "product_identifier")
    known = listed.join(first_work, ASSET, "left").join(master, ASSET, "left")
    causes = (
        F.when(F.col("first_work").isNull(), "no work")
        .when(F.col("installed").isNull(), "not in master")
        .when(F.col("installed") > as_date(as_of), "installed after as_of")
    )
    if sources.asset_features is not None:
        products = sources.asset_features.select("product_identifier").distinct().withColumn("known", F.lit(True))
        known = known.join(products, "product_identifier", "left")
        causes = causes.when(F.col("known").isNull(), "no device row")
    return known.select(ASSET, causes.alias("cause")).filter(F.col("cause").isNotNull())


def operational_age(facts: DataFrame, assets: DataFrame, operational_days: DataFrame, min_hours: float = 0) -> DataFrame:
    """Operating days in [install, date] for a table of days that is already dense; an asset without operating weekdays stays
    at 0. In a fact job, give FactSources.operational_days instead: nothing is then joined to days."""
    weekdays = (
        operational_days.filter(F.col("operational_hours").isNotNull() & (F.col("operational_hours") >= min_hours))
        .groupBy(F.col("id").alias(ASSET))
        .agg(F.collect_set(F.col("day").cast("int")).alias("weekdays"))
    )
    known = assets.groupBy(ASSET).agg(F.min("installed_date").alias("installed_date")).join(weekdays, ASSET, "left")
    days = F.coalesce(operating_days_between(F.col("installed_date"), F.col(DATE), F.col("weekdays")), F.lit(0))
    return facts.join(known, ASSET).select(*facts.columns, days.alias("operational_age"))


def row_change(
    facts: DataFrame, columns: Sequence[str] = tuple(CHANGE_COLUMNS), threshold: float = CHANGE_DISTANCE
) -> DataFrame:
    """Distance of each day's row to the asset's previous row, for a table of days that is already dense; null on the first
    day. In a fact job, daily_change gives the same without a window over days."""
    ordered = Window.partitionBy(ASSET).orderBy(DATE)
    previous = F.lag(F.struct(*columns)).over(ordered)
    moved = facts.select(ASSET, DATE, *columns, previous.alias("previous"))
    distance = F.when(
        F.col("previous").isNotNull(), euclidean([(F.col(name), F.col(f"previous.{name}")) for name in columns])
    )
    return with_changed(moved.select(ASSET, DATE, distance.alias("distance")), threshold)


def with_changed(distances: DataFrame, threshold: float) -> DataFrame:
    return distances.withColumn("changed", (F.col("distance") >= threshold).cast("int"))


__all__ = [
    "FactSettings",
    "FactSources",
    "Timeline",
    "daily_change",
    "daily_facts",
    "daily_work_panel",
    "dropped_assets",
    "operational_age",
    "row_change",
    "timeline",
]
