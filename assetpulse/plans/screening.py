"""Asset screening: five data-quality rules, the valid-asset list, and the reason matrix."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetpulse.constants import (
    ASSET,
    DATE,
    LOG_DAILY,
    LOG_EVENT,
    LOG_MANUAL,
    REASONS,
    STATUS_ACTIVE,
    STATUS_EVENT,
)
from assetpulse.functions import as_date
from assetpulse.operators.joins import restrict_to

# Column names of the reason matrix.
MATRIX_FLAGS = [
    "daily_notes_present",
    "selected_for_ML",
    "error_log",
    "install_date_in_future",
    "daily_work_for_60days",
    "no_daily_work_for_60_days",
    "work_missing_for_15_consecutive_days",
    "perfect_daily_work",
    "Log status 1",
    "Log 1&2",
    "Log 2",
    "Active Asset",
    "inactive Asset",
]


@dataclass(frozen=True)
class ScreenSettings:
    """variant 'life_events' reads the active status from life events, 'master' from the asset master."""

    variant: str = "life_events"
    min_rows: int = 60
    max_irregular_run: int = 15
    max_gap_days: int = 15

    def __post_init__(self):
        if self.variant not in ("life_events", "master"):
            raise ValueError("variant is 'life_events' or 'master'")


def work_profile(work: DataFrame) -> DataFrame:
    """Per asset: rows, date range, longest run of irregular steps, longest gap in days.

    A step to the next row is regular if that row is exactly one day later. Rows are first counted per
    (asset, day); k rows on one day are k-1 irregular steps. So the window below sees at most one row
    per calendar day of an asset, however many rows it has.
    """
    daily = work.groupBy(ASSET, DATE).agg(F.count("*").alias("n"))
    ordered = Window.partitionBy(ASSET).orderBy(DATE)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    step = F.datediff(F.lead(DATE).over(ordered), F.col(DATE))
    steps = daily.withColumn("step", step)
    # A regular step closes an island; the day after it opens the next one.
    island = F.coalesce(F.sum((F.col("step") == 1).cast("int")).over(before), F.lit(0))
    irregular = F.col("n") - 1 + F.when(F.col("step") > 1, 1).otherwise(0)
    islands = (
        steps.select(ASSET, DATE, "n", "step", island.alias("island"), irregular.alias("irregular"))
        .groupBy(ASSET, "island")
        .agg(
            F.sum("irregular").alias("run"),
            F.sum("n").alias("n"),
            F.max("step").alias("gap"),
            F.min(DATE).alias("first_date"),
            F.max(DATE).alias("last_date"),
        )
    )
    return islands.groupBy(ASSET).agg(
        F.sum("n").alias("work_rows"),
        F.max("run").alias("longest_irregular_run"),
        F.max("gap").alias("longest_gap"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def life_event_profile(life_events: DataFrame) -> DataFrame:
    """Per asset: which status and log values ever occurred."""
    code = F.col("life_event_code").cast("int")
    value = F.col("life_event_value").cast("int")

    def ever(condition):
        return F.coalesce(F.max(condition), F.lit(False))

    return (
        life_events.filter(code.isin(STATUS_EVENT, LOG_EVENT))
        .groupBy(ASSET)
        .agg(
            ever((code == STATUS_EVENT) & value.eqNullSafe(STATUS_ACTIVE)).alias("ever_active"),
            ever((code == STATUS_EVENT) & ~value.eqNullSafe(STATUS_ACTIVE)).alias("ever_inactive"),
            ever((code == LOG_EVENT) & value.eqNullSafe(LOG_DAILY)).alias("log_daily"),
            ever((code == LOG_EVENT) & value.eqNullSafe(LOG_MANUAL)).alias("log_manual"),
        )
    )


def master_profile(assets: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Per asset of the master: future install and status."""
    active = F.col("active_status").eqNullSafe("Active")
    return assets.groupBy(ASSET).agg(
        F.max(F.coalesce(F.col("installed_date") > as_date(as_of), F.lit(False))).alias("future_install"),
        F.max(active).alias("master_active"),
        F.max(~active).alias("master_not_active"),
        F.lit(True).alias("in_master"),
    )


def asset_status(
    work: DataFrame,
    assets: DataFrame,
    life_events: DataFrame,
    as_of: dt.date | str,
    settings: ScreenSettings | None = None,
) -> DataFrame:
    """One row per asset that has work or is in the master, with every rule as a flag.

    All rules, lists and counts below are filters on this one table.
    """
    settings = settings or ScreenSettings()
    profile = (
        work_profile(work)
        .withColumn("has_work", F.lit(True))
        .join(master_profile(assets, as_of), ASSET, "full")
        .join(life_event_profile(life_events), ASSET, "left")
    )

    def flag(name):
        return F.coalesce(F.col(name), F.lit(False))

    has_work = flag("has_work")
    future = flag("future_install")
    by_events = settings.variant == "life_events"
    active = flag("ever_active" if by_events else "master_active")
    inactive = flag("ever_inactive" if by_events else "master_not_active")
    irregular = F.coalesce(F.col("longest_irregular_run") > settings.max_irregular_run, F.lit(False))
    gap = F.coalesce(F.col("longest_gap") > settings.max_gap_days, F.lit(False))
    enough = F.coalesce(F.col("work_rows") > settings.min_rows, F.lit(False))
    future_counts = future if by_events else future & has_work
    status = profile.select(
        ASSET,
        has_work.alias("has_work"),
        flag("in_master").alias("in_master"),
        (has_work if by_events else flag("in_master")).alias("in_universe"),
        (has_work & active).alias("active"),
        (has_work & inactive).alias("inactive"),
        (has_work & flag("log_daily")).alias("log_daily"),
        (has_work & flag("log_manual") & ~flag("log_daily")).alias("manual_only"),
        (has_work & flag("log_daily") & ~flag("log_manual")).alias("daily_only"),
        (has_work & flag("log_daily") & flag("log_manual")).alias("daily_and_manual"),
        (has_work & irregular).alias("irregular"),
        (has_work & ~irregular).alias("regular"),
        (has_work & gap).alias("long_gap"),
        (has_work & enough).alias("enough_rows"),
        (has_work & ~enough).alias("too_few_rows"),
        future_counts.alias("future_install"),
        "first_date",
        "last_date",
    )
    failed = F.col("inactive") | F.col("manual_only") | F.col("irregular") | F.col("too_few_rows")
    return status.withColumn("failed", failed | F.col("future_install"))


def reason_rows(status: DataFrame, flag: str, reason: int) -> DataFrame:
    return status.filter(F.col(flag)).select(ASSET, F.lit(reason).alias("reason_id"))


def error_log(status: DataFrame) -> DataFrame:
    """All (asset, reason) pairs, by one pass over the status table."""
    rules = {1: "inactive", 2: "manual_only", 3: "irregular", 4: "too_few_rows", 5: "future_install"}
    reasons = F.array_compact(F.array(*[F.when(F.col(flag), reason) for reason, flag in rules.items()]))
    return status.filter("failed").select(ASSET, F.explode(reasons).alias("reason_id"))


def named_reasons(errors: DataFrame) -> DataFrame:
    """Error log with the wording of each reason."""
    names = F.create_map(*[F.lit(item) for pair in REASONS.items() for item in pair])
    return errors.select(ASSET, "reason_id", names[F.col("reason_id")].alias("reason"))


def valid_assets(status: DataFrame) -> DataFrame:
    return status.filter(F.col("in_universe") & ~F.col("failed")).select(F.col(ASSET).alias("id"))


def error_assets(status: DataFrame) -> DataFrame:
    """Assets of the universe that failed a rule."""
    return status.filter(F.col("in_universe") & F.col("failed")).select(ASSET)


def category(status: DataFrame, flag: str) -> DataFrame:
    """Id list of one category, such as 'manual_only' or 'enough_rows'."""
    return status.filter(F.col(flag)).select(ASSET)


def screening_summary(status: DataFrame) -> DataFrame:
    """Category sizes as (metric, value)."""
    metrics = {
        "assets with daily work": F.col("has_work"),
        "active assets": F.col("active"),
        "inactive assets": F.col("inactive"),
        "daily log only": F.col("daily_only"),
        "manual log only": F.col("manual_only"),
        "daily log": F.col("log_daily"),
        "missing work": F.col("irregular"),
        "perfect work": F.col("regular"),
        "enough work": F.col("enough_rows"),
        "too little work": F.col("too_few_rows"),
        "future install": F.col("future_install"),
        "in error log": F.col("in_universe") & F.col("failed"),
        "passing all filters": F.col("in_universe") & ~F.col("failed"),
    }
    counts = status.agg(*[F.count_if(condition).alias(name) for name, condition in metrics.items()])
    return counts.unpivot([], list(metrics), "metric", "value")


def reason_matrix(assets: DataFrame, status: DataFrame) -> DataFrame:
    """Thirteen 0/1 flags per master row and one total row, whose id is null."""
    flags = {
        "daily_notes_present": F.col("has_work"),
        "selected_for_ML": F.col("in_universe") & ~F.col("failed"),
        "error_log": F.col("in_universe") & F.col("failed"),
        "install_date_in_future": F.col("future_install"),
        "daily_work_for_60days": F.col("enough_rows"),
        "no_daily_work_for_60_days": F.col("too_few_rows"),
        "work_missing_for_15_consecutive_days": F.col("irregular"),
        "perfect_daily_work": F.col("regular"),
        "Log status 1": F.col("daily_only"),
        "Log 1&2": F.col("daily_and_manual"),
        "Log 2": F.col("manual_only"),
    }
    per_asset = status.select(ASSET, *[condition.alias(name) for name, condition in flags.items()])
    master = assets.select(
        ASSET,
        (F.col("active_status") == "Active").alias("Active Asset"),
        (F.col("active_status") == "Inactive").alias("inactive Asset"),
    )
    rows = master.join(per_asset, ASSET, "left").select(
        F.col(ASSET).alias("product_id"),
        *[F.coalesce(F.col(f"`{name}`").cast("int"), F.lit(0)).cast("long").alias(name) for name in MATRIX_FLAGS],
    )
    total = rows.agg(*[F.sum(f"`{name}`").alias(name) for name in MATRIX_FLAGS])
    return rows.unionByName(total.withColumn("product_id", F.lit(None).cast("long")))


def spot_check(
    assets: DataFrame, life_events: DataFrame, errors: DataFrame, seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One pseudo-random asset: its id, master rows, life events and error-log rows.

    The asset with the least hash of (seed, id) is picked, so the pick does not depend on partitioning.
    """
    drawn = F.md5(F.concat_ws(":", F.lit(seed), F.col(ASSET)))
    pick = assets.select(ASSET).orderBy(drawn, ASSET).limit(1)
    return pick, restrict_to(assets, pick), restrict_to(life_events, pick), restrict_to(errors, pick)


@dataclass(frozen=True)
class Screening:
    """Result of a run: the per-asset status and the tables derived from it."""

    status: DataFrame
    error_log: DataFrame
    valid: DataFrame
    summary: DataFrame

    def valid_ids(self) -> DataFrame:
        return self.valid

    def error_ids(self) -> DataFrame:
        return error_assets(self.status)

    def category(self, flag: str) -> DataFrame:
        return category(self.status, flag)


def screen_assets(
    assets: DataFrame,
    work: DataFrame,
    life_events: DataFrame,
    as_of: dt.date | str,
    settings: ScreenSettings | None = None,
) -> Screening:
    status = asset_status(work, assets, life_events, as_of, settings)
    return Screening(status, error_log(status), valid_assets(status), screening_summary(status))
