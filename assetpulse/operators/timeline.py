"""Asset timeline: the state of each asset at the days on which anything changes.

A fact row exists for every asset and day, but between two changes all running values are constant and
all day counts are plain arithmetic. So windows run over change days only, and the dense days are
produced last, by a narrow explode:

1. daily signals are stacked and shuffled once, by asset;
2. a value that enters an n-day rolling window also leaves it n days later: it is emitted twice, with
   plus and minus sign, and the rolling sum is a running sum;
3. running sums, last and next events are computed over change days in one sorted pass;
4. each change day is expanded up to the day before the next one, without shuffle, sort or join.

Per asset there are at most two rows per calendar day, however many raw rows it had.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetpulse.constants import ASSET, DATE
from assetpulse.functions import as_date, days_in_mask, ratio

COUNTERS = {"work": "long", "pm": "long", "failure": "long", "code_failure": "long"}
OPERATING_WEEKDAYS = "operating_weekdays"
OTHERS = {"has_work": "boolean", "firmware": "int", "has_firmware": "boolean"}


@dataclass(frozen=True)
class TimelineSettings:
    as_of: dt.date | str
    window_days: int = 30
    pm_scope: str = "from_install"
    attributes: tuple[str, ...] = ()
    partitions: int | None = None
    code_columns: tuple[str, ...] = ()

    def __post_init__(self):
        if self.pm_scope not in ("from_install", "from_start"):
            raise ValueError("pm_scope is 'from_install' or 'from_start'")
        if self.window_days < 2:
            raise ValueError("window_days must be at least 2")


def stack_signals(signals: Sequence[DataFrame], settings: TimelineSettings) -> DataFrame:
    """All signals as one long table, hash-partitioned by asset; the only shuffle by asset.

    The partition count is given, since later steps of the same stage multiply the rows: coalescing by
    the bytes of this shuffle, as adaptive execution would do, leaves tasks too large. Without settings.partitions it is
    the session's number of shuffle partitions.
    """
    stacked = reduce(lambda top, bottom: top.unionByName(bottom, allowMissingColumns=True), signals)
    expected = {**COUNTERS, **OTHERS, **{name: "long" for name in settings.code_columns}}
    absent = {name: F.lit(None).cast(kind) for name, kind in expected.items() if name not in stacked.columns}
    partitions = settings.partitions or int(stacked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stacked.withColumns(absent).repartition(partitions, ASSET)


def with_bounds(stacked: DataFrame, settings: TimelineSettings) -> DataFrame:
    """Adds install, start (first day of the asset's facts) and the attributes; assets without either day are dropped, as
    are the rows without a day, which only carry attributes."""
    whole = f"OVER (PARTITION BY {ASSET})"
    bounds = [f"min(installed) {whole} AS install", f"min(CASE WHEN has_work THEN day END) {whole} AS first_work"]
    bounds += [f"max({name}) {whole} AS asset_{name}" for name in settings.attributes]
    return (
        stacked.selectExpr("*", *bounds)
        .filter("install IS NOT NULL AND first_work IS NOT NULL AND day IS NOT NULL")
        .withColumn("start", F.greatest("install", "first_work"))
        .filter(F.col("start") <= as_date(settings.as_of))
    )


def change_days(bounded: DataFrame, settings: TimelineSettings) -> DataFrame:
    """One row per asset and change day, with what enters and leaves on it."""
    rolling = ["work", *settings.code_columns]
    anything = " OR ".join(f"coalesce({name}, 0) != 0" for name in rolling)
    later = f"date_add(day, {settings.window_days})"
    leaves = f"day >= start AND ({anything}) AND {later} <= last_day"
    signed = bounded.withColumn("last_day", as_date(settings.as_of)).selectExpr(
        "*", f"explode(CASE WHEN {leaves} THEN array(1, -1) ELSE array(1) END) AS sign"
    )
    # Work and codes before start do not count, nor do requests before install.
    sums = ["coalesce(sum(CASE WHEN sign = 1 AND day >= start THEN work END), 0) AS work"]
    sums += [
        f"coalesce(sum(CASE WHEN sign = 1 AND day >= install THEN {name} END), 0) AS {name}"
        for name in ("pm", "failure", "code_failure")
    ]
    sums += [f"coalesce(sum(CASE WHEN day >= start THEN sign * {name} END), 0) AS in_{name}" for name in rolling]
    sums += [
        f"coalesce(sum(CASE WHEN day >= start THEN sign * {name} * {name} END), 0) AS in2_{name}"
        for name in settings.code_columns
    ]
    sums += [
        "max(CASE WHEN sign = 1 THEN firmware END) AS firmware",
        "coalesce(max(CASE WHEN sign = 1 THEN has_firmware END), false) AS has_firmware",
    ]
    keys = [ASSET, "install", "start", *[f"asset_{name}" for name in settings.attributes]]
    effective = signed.withColumn("day", F.expr(f"CASE WHEN sign = 1 THEN day ELSE {later} END"))
    return effective.groupBy(*keys, "day").agg(*[F.expr(total) for total in sums])


def asset_states(changes: DataFrame, settings: TimelineSettings) -> DataFrame:
    """State that holds from each change day up to the day before next_day.

    The nearest later event is read with lead(...) IGNORE NULLS, a pointer that only moves forward; a
    frame to the end of the partition would be read again for every row.
    """
    window = f"PARTITION BY {ASSET} ORDER BY day"
    so_far = f"OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    counted_pm = "pm > 0 AND day >= start" if settings.pm_scope == "from_start" else "pm > 0"
    marked = changes.selectExpr(
        "*",
        f"CASE WHEN {counted_pm} THEN day END AS pm_day",
        "CASE WHEN failure > 0 THEN day END AS failure_day",
        "CASE WHEN code_failure > 0 AND day >= start THEN day END AS code_failure_day",
        "CASE WHEN has_firmware THEN struct(firmware) END AS firmware_set",
    )
    columns = [
        f"lead(day) OVER ({window}) AS following_day",
        f"sum(work) {so_far} AS work_total",
        f"max(pm_day) {so_far} AS last_pm_day",
        f"max(failure_day) {so_far} AS last_failure_day",
        f"sum(failure) {so_far} AS incidents",
        f"last(firmware_set, true) {so_far} AS firmware_now",
    ]
    columns += [
        f"lead({column}, 1) IGNORE NULLS OVER ({window}) AS later_{column}"
        for column in ("failure_day", "code_failure_day", "firmware")
    ]
    columns += [f"sum(in_{name}) {so_far} AS roll_{name}" for name in ["work", *settings.code_columns]]
    columns += [f"sum(in2_{name}) {so_far} AS roll2_{name}" for name in settings.code_columns]
    # Work up to the day before the latest maintenance in the fact range; the maintenance day opens a new count.
    before_pm = f"last(CASE WHEN pm > 0 AND day >= start THEN work_total - work END, true) {so_far} AS work_before_pm"
    states = marked.selectExpr("*", *columns).selectExpr("*", before_pm)
    return (
        states.filter("day >= start")
        .withColumn("next_day", F.coalesce("following_day", F.date_add(as_date(settings.as_of), 1)))
        .selectExpr(*_state_columns(settings))
    )


def _state_columns(settings: TimelineSettings) -> list[str]:
    """What expanded rows need. Anything that holds for the whole span is computed here, once per change day."""
    n = settings.window_days
    columns = [
        ASSET,
        "install",
        "day",
        "next_day",
        f"date_add(start, {n - 1}) AS full_window_from",
        "work",
        "work_total",
        "work_total - coalesce(work_before_pm, 0) AS work_since_pm",
        "roll_work",
        "coalesce(last_pm_day, install) AS pm_anchor",
        "coalesce(last_failure_day, install) AS failure_anchor",
        "incidents",
        "coalesce(failure_day, later_failure_day) AS next_failure_day",
        "later_failure_day",
        "coalesce(code_failure_day, later_code_failure_day) AS next_code_failure_day",
        "later_code_failure_day",
        "coalesce(firmware_now.firmware, later_firmware) AS firmware_in_force",
    ]
    for name in settings.attributes:
        if name == OPERATING_WEEKDAYS:
            columns.append(f"{weekdays_from_install(f'asset_{name}')} AS operating_from_install")
        else:
            columns.append(f"asset_{name} AS {name}")
    for name in settings.code_columns:
        # Sample deviation from exact integer sums.
        squared = f"CAST(roll2_{name} * {n} - roll_{name} * roll_{name} AS DOUBLE)"
        columns += [f"roll_{name}", f"sqrt({squared} / {float(n * (n - 1))}D) AS spread_{name}"]
    return columns


def weekdays_from_install(mask: str) -> str:
    """SQL: a mask of weekdays (bit 0 is Sunday) turned so that bit 0 is the weekday of install; null is no weekday."""
    first = "(dayofweek(install) - 1)"
    return f"((shiftright(coalesce({mask}, 0), {first}) | shiftleft(coalesce({mask}, 0), 7 - {first})) & 127)"


def with_previous(states: DataFrame) -> DataFrame:
    """Adds the columns of the asset's state before this one as before_*; unused ones are pruned. The rows are in order already,
    so this is one more function in the sorted pass over change days."""
    window = f"PARTITION BY {ASSET} ORDER BY day"
    return states.selectExpr("*", *[f"lag({name}) OVER ({window}) AS before_{name}" for name in states.columns if name != ASSET])


def expand_days(
    states: DataFrame, first_date: dt.date | str | None = None, last_date: dt.date | str | None = None
) -> DataFrame:
    """One row per asset and day, from each change day to the day before the next.

    A date range is applied to the change days, so that days outside it are never produced.
    """
    first, last = F.col("day"), F.date_sub("next_day", 1)
    if first_date is not None:
        first = F.greatest(first, as_date(first_date))
    if last_date is not None:
        last = F.least(last, as_date(last_date))
    return states.filter(first <= last).withColumn(DATE, F.explode(F.sequence(first, last)))


def fact_columns(
    settings: TimelineSettings,
    horizon_days: int = 30,
    cap_days: int = 180,
    failure_label: str = "requests",
    state: Callable[[str], Column] = F.col,
    today: Column | None = None,
) -> dict[str, Column]:
    """Fact columns as arithmetic on an expanded state row: those of the day `today` (the row's day) in the state that
    `state` reads (the row's own)."""
    if failure_label not in ("requests", "error_codes"):
        raise ValueError("failure_label is 'requests' or 'error_codes'")
    today = F.col(DATE) if today is None else today
    on_change_day = today == state("day")
    age = F.datediff(today, state("install"))

    def days_to(kind: str) -> Column:
        following = F.when(on_change_day, state(f"next_{kind}_day")).otherwise(state(f"later_{kind}_day"))
        return F.datediff(following, today)

    label = days_to("failure" if failure_label == "requests" else "code_failure")
    columns = {
        "working_unit": F.when(on_change_day, state("work")).otherwise(F.lit(0)),
        "notes_in": state("work_total"),
        "notes_in_last30": state("roll_work"),
        "notes_in_last_pm": state("work_since_pm"),
        "last_pm_date": F.datediff(today, state("pm_anchor")),
        "age": age,
        "firmwareHistory": state("firmware_in_force"),
        "failure_event": F.coalesce((label <= horizon_days).cast("int"), F.lit(0)),
        "day_to_failure": F.least(F.coalesce(days_to("failure"), F.lit(cap_days)), F.lit(cap_days)),
        "numIncidents": state("incidents"),
        "days_Since_failure": F.datediff(today, state("failure_anchor")),
        "Avg_notes_in": ratio(state("work_total"), age),
        "Avg_notes_in_last30": ratio(state("roll_work"), F.lit(settings.window_days)),
    }
    if OPERATING_WEEKDAYS in settings.attributes:
        columns["operational_age"] = days_in_mask(state("operating_from_install"), age + 1)
    # The deviation is null until the window is full.
    for name in settings.code_columns:
        columns[name] = state(f"roll_{name}")
        columns[f"{name}_std"] = F.when(today >= state("full_window_from"), state(f"spread_{name}"))
    return columns


def previous_fact_columns(settings: TimelineSettings, **options: object) -> dict[str, Column]:
    """Fact columns of the asset's previous row: on a quiet day the same state one day earlier, on a change day the state
    before it (with_previous). Null on the asset's first day."""
    quiet = F.col(DATE) > F.col("day")

    def state(name: str) -> Column:
        return F.when(quiet, F.col(name)).otherwise(F.col(f"before_{name}"))

    known = quiet | F.col("before_day").isNotNull()
    columns = fact_columns(settings, state=state, today=F.date_sub(F.col(DATE), 1), **options)
    return {name: F.when(known, value) for name, value in columns.items()}
