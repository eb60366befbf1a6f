"""Registered queries over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetpulse import schemas
from assetpulse.constants import ASSET, CRITICALITIES_SHORT, DATE, LISTED_CODES_SHORT, LOG_EVENT, LOG_MANUAL, MODEL_CUTOFFS
from assetpulse.functions import at_most, date_label, parse_date
from assetpulse.operators import coverage, filters, model, ranking
from assetpulse.operators import reference_tables as ref
from assetpulse.plans import daily_facts as facts
from assetpulse.plans import fleet, screening
from assetpulse.plans.bridge import AS_OF, FIRMWARE_TIE_BREAK, SCREEN_AS_OF, TIE_BREAK, Bridge
from assetpulse.session import materialize, use_checkpoint_dir
from assetpulse.sources import (
    checked_for_sink,
    drop_any_null,
    read_csv,
    read_id_list,
    valid_dates,
    write_csv,
    write_dated,
    write_facts,
)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *exact: str, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison with another engine, but for those that both engines give bit by bit."""
    columns = []
    for field in df.schema.fields:
        value = f"`{field.name}`"
        if isinstance(field.dataType, T.DoubleType) and field.name not in exact:
            # Plain arithmetic; the decimal arithmetic of round() costs more than the queries. NaN and infinity stay.
            value = f"if(abs({value}) < 1e12D, floor({value} * 1e{places}D + 0.5D) / 1e{places}D, {value}) AS {value}"
        columns.append(value)
    return df.selectExpr(*columns)


def fact_sources(bridge: Bridge, *parts: str) -> facts.FactSources:
    """Sources of the fact table; parts limits the optional ones, "work" names none of them."""
    optional = {
        "service_requests": lambda: bridge.service_requests(),
        "error_events": lambda: drop_any_null(bridge.error_events()),
        "firmware": lambda: valid_dates(bridge.firmware(), "created_date"),
        "asset_features": lambda: bridge.asset_features(),
    }
    chosen = parts or tuple(optional)
    return facts.FactSources(
        work=bridge.daily_work(),
        assets=bridge.assets(),
        work_tie_break=TIE_BREAK,
        firmware_tie_break=FIRMWARE_TIE_BREAK,
        **{name: optional[name]() for name in chosen if name in optional},
    )


def bridge_facts(bridge: Bridge, *parts: str, **options) -> DataFrame:
    return facts.daily_facts(fact_sources(bridge, *parts), AS_OF, facts.FactSettings(**options))


def fact_query(columns: list[str] | None, *parts: str, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = bridge_facts(Bridge(spark, sf_dir), *parts, **options)
        return rounded(df.select(ASSET, DATE, *columns) if columns else df, "Avg_notes_in", "Avg_notes_in_last30")

    return run


def daily_spine_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = Bridge(spark, sf_dir)
    return facts.daily_work_panel(facts.FactSources(bridge.daily_work(), bridge.assets(), TIE_BREAK), AS_OF)


def code_rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bridge_facts(Bridge(spark, sf_dir), "error_events")
    return rounded(df.select(ASSET, DATE, *[name for name in df.columns if name.startswith("Code")]))


FACT_QUERIES: dict[str, Query] = {
    "daily_spine_work": daily_spine_work,
    "work_since_pm": fact_query(["notes_in_last_pm"], "service_requests"),
    "days_since_pm": fact_query(["last_pm_date"], "service_requests"),
    "days_since_pm_from_start": fact_query(["last_pm_date"], "service_requests", pm_scope="from_start"),
    "firmware_as_of": fact_query(["firmwareHistory"], "firmware"),
    "failure_labels": fact_query(["failure_event", "day_to_failure"], "service_requests"),
    "failure_labels_from_codes": fact_query(
        ["failure_event"], "error_events", failure_label="error_codes", code_types=(), codes=()
    ),
    "incident_history": fact_query(["numIncidents", "days_Since_failure"], "service_requests"),
    "age_and_averages": fact_query(["age", "Avg_notes_in", "Avg_notes_in_last30"], "work"),
    "code_rolling_features": code_rolling_features,
    "daily_facts": fact_query(None),
}


def screen_status_table(bridge: Bridge, variant: str = "life_events") -> DataFrame:
    """Limits suit the test events: 30 days of data, so runs above 6 and gaps above 2 days stand out."""
    settings = screening.ScreenSettings(variant=variant, max_irregular_run=6, max_gap_days=2)
    return screening.asset_status(
        bridge.screen_work(), bridge.screen_assets(), bridge.life_events(), SCREEN_AS_OF, settings
    )


def screen_query(build: Callable[[DataFrame], DataFrame], variant: str = "life_events") -> Query:
    return lambda spark, sf_dir: build(screen_status_table(Bridge(spark, sf_dir), variant))


def reason_query(flag: str, reason: int, variant: str = "life_events") -> Query:
    return screen_query(lambda status: screening.reason_rows(status, flag, reason), variant)


def reason_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = Bridge(spark, sf_dir)
    return screening.reason_matrix(bridge.screen_assets(), screen_status_table(bridge))


def asset_spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = Bridge(spark, sf_dir)
    errors = screening.error_log(screen_status_table(bridge))
    _, info, life, reasons = screening.spot_check(bridge.screen_assets(), bridge.life_events(), errors)
    shown = {
        "info": info.withColumn("detail", F.col("installed_date").cast("string")),
        "life event": life.withColumn("detail", F.col("life_event_description")),
        "error": reasons.withColumn("detail", F.col("reason_id").cast("string")),
    }
    parts = [
        df.groupBy(ASSET, "detail").agg(F.count("*").alias("n")).withColumn("section", F.lit(section))
        for section, df in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SCREEN_QUERIES: dict[str, Query] = {
    "screen_status": reason_query("inactive", 1),
    "screen_status_master": reason_query("inactive", 1, "master"),
    "screen_log": reason_query("manual_only", 2),
    "screen_irregular": reason_query("irregular", 3),
    "screen_gap": screen_query(lambda status: screening.category(status, "long_gap")),
    "screen_volume": reason_query("too_few_rows", 4),
    "screen_install": reason_query("future_install", 5),
    "error_log": screen_query(screening.error_log),
    "error_log_master": screen_query(screening.error_log, "master"),
    "valid_assets": screen_query(screening.valid_assets),
    "valid_assets_master": screen_query(screening.valid_assets, "master"),
    "screening_summary": screen_query(screening.screening_summary),
    "reason_matrix": reason_matrix,
    "asset_spot_check": asset_spot_check,
}


def bridge_query(build: Callable[[Bridge], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Bridge(spark, sf_dir))


def technicians(how: str) -> Query:
    """Orders name customers as assets; the master holds suppliers, so the two kinds of join differ."""
    return bridge_query(
        lambda b: ref.technician_history(b.field_activity(), b.service_orders(), b.assets(), how)
    )


REFERENCE_QUERIES: dict[str, Query] = {
    "service_request_history": bridge_query(lambda b: ref.service_request_history(b.service_requests())),
    "asset_information": bridge_query(lambda b: ref.asset_information(b.asset_information_source())),
    "error_code_feature_def": bridge_query(lambda b: ref.error_code_feature_def(b.error_code_source())),
    "error_code_rows": bridge_query(lambda b: ref.error_code_rows(b.error_events())),
    "asset_error_codes": bridge_query(lambda b: ref.asset_error_codes(b.error_events())),
    "periodic_work_left": bridge_query(lambda b: ref.periodic_work(b.screen_work(), b.assets(), "left")),
    "periodic_work_inner": bridge_query(lambda b: ref.periodic_work(b.screen_work(), b.assets(), "inner")),
    "technician_history_left": technicians("left"),
    "technician_history_inner": technicians("inner"),
    "total_assets": bridge_query(lambda b: ref.total_assets(b.screen_assets())),
    "assets_with_work_count": bridge_query(lambda b: ref.assets_with_work_count(b.screen_work(), b.screen_assets())),
    "assets_with_log_status": bridge_query(lambda b: ref.assets_with_log_status(b.life_events(), b.screen_assets())),
    "unknown_status": bridge_query(lambda b: ref.assets_of_unknown_status(b.screen_assets())),
    "orders_without_activity": bridge_query(
        lambda b: ref.orders_without_activity(b.service_orders(), b.field_activity())
    ),
    "work_coverage": bridge_query(lambda b: ref.work_coverage(b.daily_work())),
}


FILTER_FIRST, FILTER_LAST = "1998-01-01", "1998-12-31"


def visits_by_day(bridge: Bridge) -> DataFrame:
    """Field visits per day, with the day's month as text; the day is parsed from text."""
    days = bridge.field_activity().select(parse_date(F.col("date_arrival")).alias("day"))
    return days.groupBy("day").agg(F.count("*").alias("visits")).withColumn("month", date_label(F.col("day"), "yyyy-MM"))


def screen_lists(bridge: Bridge) -> DataFrame:
    """The id lists of a screening run, one under the other."""
    run = screening.screen_assets(
        bridge.screen_assets(), bridge.screen_work(), bridge.life_events(), SCREEN_AS_OF,
        screening.ScreenSettings(max_irregular_run=6, max_gap_days=2),
    )
    lists = {"valid": run.valid_ids(), "error": run.error_ids(), "manual": run.category("manual_only"), "regular": run.category("regular")}
    named = [ids.select(F.lit(name).alias("list"), F.col(ids.columns[0]).alias("id")) for name, ids in lists.items()]
    return named[0].union(named[1]).union(named[2]).union(named[3])


FILTER_QUERIES: dict[str, Query] = {
    "assets_active": bridge_query(lambda b: filters.status_is(b.screen_assets(), "Active").select(ASSET)),
    "assets_not_active": bridge_query(lambda b: filters.status_not(b.screen_assets(), "Active").select(ASSET, "active_status")),
    "maintenance_requests": bridge_query(
        lambda b: filters.with_const(filters.pm_requests(b.service_requests(), FILTER_FIRST, FILTER_LAST), customer_id=ref.CUSTOMER)
    ),
    "failure_requests": bridge_query(lambda b: filters.failure_requests(b.service_requests(), FILTER_FIRST, FILTER_LAST)),
    "manual_log_events": bridge_query(lambda b: filters.life_events_where(b.fleet_life_events(), LOG_EVENT, LOG_MANUAL)),
    "last_work_of_day": bridge_query(
        lambda b: filters.keep_last(b.daily_work(), [ASSET, DATE], [name for name, _ in TIE_BREAK]).select(ASSET, DATE, "working_unit")
    ),
    "error_log_named": screen_query(lambda status: screening.named_reasons(screening.error_log(status))),
    "visits_by_day": bridge_query(visits_by_day),
    "screen_lists": bridge_query(screen_lists),
}

TRAIN_END = "2001-04-30"
TEST_START, TEST_END = "2001-05-01", "2001-05-30"
MODEL_FIRST_DATE = "1998-01-01"


def prepared_facts(bridge: Bridge, sources: facts.FactSources | None = None) -> DataFrame:
    return fleet.prepared_facts(
        sources or fact_sources(bridge), bridge.security_map(), bridge.model_map(), AS_OF, TEST_END, MODEL_FIRST_DATE
    )


def ml_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prepared_facts(Bridge(spark, sf_dir)), "Avg_notes_in", "Avg_notes_in_last30")


# Limits that part the assets of the fact bridge: about 200 work rows each, runs of 20 to 100 irregular steps.
FLEET_LIMITS = screening.ScreenSettings(min_rows=185, max_irregular_run=45)


def bridge_fleet(bridge: Bridge, *parts: str) -> fleet.Fleet:
    return fleet.screen_fleet(fact_sources(bridge, *parts), bridge.fleet_life_events(), AS_OF, FLEET_LIMITS)


def daily_facts_valid(bridge: Bridge) -> DataFrame:
    return rounded(bridge_fleet(bridge).facts(), "Avg_notes_in", "Avg_notes_in_last30")


def ml_prepared_valid(bridge: Bridge) -> DataFrame:
    return rounded(prepared_facts(bridge, bridge_fleet(bridge).sources), "Avg_notes_in", "Avg_notes_in_last30")


def firmware_from_life_events(source: str) -> Query:
    """Firmware as of each day, from life events or from both sources."""

    def build(bridge: Bridge) -> DataFrame:
        events = filters.firmware_from_life_events(bridge.fleet_life_events(), "life_event_code", "life_event_value")
        sources = replace(fact_sources(bridge, "firmware"), firmware_events=valid_dates(events, "created_date"))
        return facts.daily_facts(sources, AS_OF, facts.FactSettings(firmware_source=source)).select(ASSET, DATE, "firmwareHistory")

    return bridge_query(build)


ELIGIBLE_AFTER = "1996-12-31"

FLEET_QUERIES: dict[str, Query] = {
    "daily_facts_valid": bridge_query(daily_facts_valid),
    "dropped_assets": bridge_query(lambda b: bridge_fleet(b).dropped()),
    "ml_prepared_valid": bridge_query(ml_prepared_valid),
    "log_status_throughout": bridge_query(
        lambda b: coverage.log_status_throughout(b.fleet_life_events(), b.daily_work(), AS_OF)
    ),
    "eligible_assets": bridge_query(
        lambda b: coverage.eligible_assets(b.assets(), b.daily_work(), b.fleet_life_events(), AS_OF, ELIGIBLE_AFTER, 400, 180)
    ),
    "firmware_from_life_events": firmware_from_life_events("life_events"),
    "firmware_history_first": firmware_from_life_events("history_first"),
    "firmware_life_events_first": firmware_from_life_events("life_events_first"),
}


def time_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = Bridge(spark, sf_dir)
    panel = facts.daily_work_panel(facts.FactSources(bridge.daily_work(), bridge.assets(), TIE_BREAK), AS_OF)
    return model.split_counts(*model.time_split(panel, TRAIN_END))


def scored_report(bridge: Bridge) -> DataFrame:
    """Every test day's assets, with the time since failure as a plain score in place of a forest's."""
    days = bridge_facts(bridge, "service_requests", first_date=TEST_START, last_date=TEST_END)
    score = F.least(F.col("days_Since_failure") / F.lit(365.0), F.lit(1.0))
    return days.select(
        DATE, ASSET, "failure_event", "notes_in_last_pm", "day_to_failure", "days_Since_failure", score.alias("mdl_pred")
    )


def model_groups(report: DataFrame) -> DataFrame:
    return ranking.score_groups(report, "mdl_pred", "failure_event")


def baseline_groups(report: DataFrame) -> DataFrame:
    """The baseline score rises strictly with this value within a date, so both give the same curves."""
    return ranking.score_groups(report, "notes_in_last_pm", "failure_event")


def baseline_score(bridge: Bridge) -> DataFrame:
    scored = ranking.baseline_score(scored_report(bridge))
    return rounded(scored.select(DATE, ASSET, "notes_in_last_pm", "pctl_bl"))


CURVE = ("curve", DATE)


def both_curves(curve: Callable[..., DataFrame], **options) -> Query:
    """A curve operator on the model score and on the baseline value, stacked: one pass over the report, one grouping."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scores = F.array(
            F.struct(F.lit("model").alias("curve"), F.col("mdl_pred").alias("score")),
            F.struct(F.lit("baseline").alias("curve"), F.col("notes_in_last_pm").cast("double").alias("score")),
        )
        report = scored_report(Bridge(spark, sf_dir)).select(DATE, "failure_event", F.inline(scores))
        groups = ranking.score_groups(report, "score", "failure_event", by=CURVE)
        return rounded(curve(groups, by=CURVE, **options))

    return run


# Bands inside the value range of the test data.
REPORT_BASELINE_CUTOFFS = {"red": 1300.0, "orange": 1000.0}


def cutoff_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = scored_report(Bridge(spark, sf_dir))
    on_model = ranking.cutoff_points(model_groups(report), report, "mdl_pred", MODEL_CUTOFFS)
    on_baseline = ranking.cutoff_points(
        baseline_groups(report), report, "notes_in_last_pm", REPORT_BASELINE_CUTOFFS
    )
    parts = on_model.withColumn("curve", F.lit("model")), on_baseline.withColumn("curve", F.lit("baseline"))
    return rounded(parts[0].unionByName(parts[1]))


def classification_metrics(bridge: Bridge) -> DataFrame:
    report = scored_report(bridge).withColumn("prediction", at_most(F.col("mdl_pred"), 0.5))
    return rounded(model.results_table({"recent failure": model.evaluate(report)}))


def regression_metrics(bridge: Bridge) -> DataFrame:
    report = scored_report(bridge)
    metrics = model.evaluate(report, "day_to_failure", "days_Since_failure", mode="regression")
    return rounded(model.results_table({"time since failure": metrics}))


def forest_run(bridge: Bridge) -> model.ModelRun:
    """Fits the forest on the training days, stores it in the shared folder and scores the test days with the stored model. Fact
    rows are read by several passes, so they are written once."""
    prepared = materialize(prepared_facts(bridge))
    folder = f"{bridge.spark.sparkContext.getCheckpointDir()}/forest-{uuid.uuid4()}"
    return model.run_model(prepared, TRAIN_END, store=folder, trained_on=AS_OF)


def forest_predictions(bridge: Bridge) -> DataFrame:
    return forest_run(bridge).predictions


def forest_report(bridge: Bridge) -> DataFrame:
    """The report of the last test day, with scores replaced by whether they are probabilities."""
    fit = F.col("mdl_pred").between(0.0, 1.0).cast("int").alias("is_probability")
    return forest_run(bridge).report.select(DATE, ASSET, "failure_event", "notes_in_last_pm", fit)


def forest_metrics(bridge: Bridge) -> DataFrame:
    """What does not depend on the trees: the class sizes in the confusion counts, and whether the metrics are shares."""
    predictions = forest_run(bridge).predictions
    counts = model.confusion(predictions).select((F.col("tn") + F.col("fp")).alias("negatives"), (F.col("fn") + F.col("tp")).alias("positives"))
    shares = [F.col(name).between(0.0, 1.0) for name in ("recall", "precision", "accuracy")]
    fit = model.evaluate(predictions).select((shares[0] & shares[1] & shares[2]).cast("int").alias("are_shares"))
    return counts.withColumn("are_shares", fit.scalar())


def class_weights(bridge: Bridge) -> DataFrame:
    """Of the training days; the label alone is needed."""
    days = bridge_facts(bridge, "service_requests", first_date=MODEL_FIRST_DATE, last_date=TRAIN_END)
    return rounded(model.class_weights(days))


REPORT_DAYS = ["2001-05-10", "2001-05-30"]


def stand_in_predictions(bridge: Bridge) -> DataFrame:
    return scored_report(bridge).withColumnRenamed("mdl_pred", "failure_probability")


def score_report(bridge: Bridge) -> DataFrame:
    predictions = stand_in_predictions(bridge)
    return rounded(model.score_report(predictions, predictions, REPORT_DAYS))


MODEL_QUERIES: dict[str, Query] = {
    "prediction_slice": bridge_query(lambda b: rounded(model.prediction_slice(stand_in_predictions(b), REPORT_DAYS))),
    "score_report": bridge_query(score_report),
    "ml_prepared": ml_prepared,
    "time_split_counts": time_split_counts,
    "baseline_score": bridge_query(baseline_score),
    "precision_curve": both_curves(ranking.precision_curve),
    "precision_curve_top10": both_curves(ranking.precision_curve, top=10),
    "gain_curve": both_curves(ranking.gain_curve),
    "curve_area": both_curves(ranking.curve_area),
    "roc_auc": both_curves(ranking.roc_auc),
    "cutoff_points": cutoff_points,
    "reference_lines": bridge_query(lambda b: rounded(ranking.reference_lines(scored_report(b), "failure_event"))),
    "classification_metrics": bridge_query(classification_metrics),
    "regression_metrics": bridge_query(regression_metrics),
    "forest_predictions": bridge_query(forest_predictions),
    "forest_report": bridge_query(forest_report),
    "forest_metrics": bridge_query(forest_metrics),
    "class_weights": bridge_query(class_weights),
}


def operational_age(bridge: Bridge) -> DataFrame:
    sources = facts.FactSources(bridge.daily_work(), bridge.assets(), TIE_BREAK, operational_days=bridge.operational_days())
    return facts.daily_facts(sources, AS_OF).select(ASSET, DATE, "age", "operational_age")


def row_change(bridge: Bridge) -> DataFrame:
    settings = facts.FactSettings(criticalities=CRITICALITIES_SHORT, codes=LISTED_CODES_SHORT)
    return rounded(facts.daily_change(fact_sources(bridge, "service_requests", "error_events"), AS_OF, settings))


def other_windows(bridge: Bridge) -> DataFrame:
    """Windows of a week, a label of ten days ahead, distances up to 90 days."""
    settings = facts.FactSettings(window_days=7, horizon_days=10, cap_days=90, code_types=(), codes=(160, 177), device_columns=None)
    days = facts.daily_facts(fact_sources(bridge, "service_requests", "error_events"), AS_OF, settings)
    codes = [name for name in days.columns if name.startswith("Code")]
    return rounded(days.select(ASSET, DATE, "notes_in_last30", "Avg_notes_in_last30", "failure_event", "day_to_failure", *codes), "Avg_notes_in_last30")


def codes_without_listed(bridge: Bridge) -> DataFrame:
    """Code groups that leave out the codes counted on their own."""
    settings = facts.FactSettings(exclude_listed_codes=True, device_columns=None)
    days = facts.daily_facts(fact_sources(bridge, "error_events"), AS_OF, settings)
    return rounded(days.select(ASSET, DATE, *[name for name in days.columns if name.startswith("CodeType")]))


def devices_from_master(bridge: Bridge) -> DataFrame:
    sources = facts.FactSources(bridge.daily_work(), bridge.assets_with_devices(), TIE_BREAK)
    return facts.daily_facts(sources, AS_OF, facts.FactSettings(device_columns="master")).select(ASSET, DATE, "age", "model_name", "capacity")


def no_devices(bridge: Bridge) -> DataFrame:
    """A device table is given and not used; the rows keep to assets, whatever their product."""
    days = facts.daily_facts(fact_sources(bridge, "asset_features"), AS_OF, facts.FactSettings(device_columns=None))
    return days.drop("Avg_notes_in", "Avg_notes_in_last30")


def sunk(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """df through the checks of a declared table, written as that table's rows of one date and read back."""
    folder = shared_folder(df.sparkSession, name)
    write_dated(checked_for_sink(df, schema), folder, AS_OF)
    return df.sparkSession.read.parquet(folder).drop("as_of")


def sink_service_requests(bridge: Bridge) -> DataFrame:
    """Requests with a category; the declared table takes no nulls."""
    history = ref.service_request_history(bridge.service_requests()).filter("incident_category IS NOT NULL")
    return sunk(history, schemas.SERVICE_REQUEST_HISTORY, "service_request_history")


def shared_folder(session: SparkSession, name: str) -> str:
    use_checkpoint_dir(session)
    return f"{session.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4()}"


def facts_from_csv(bridge: Bridge) -> DataFrame:
    """The work panel through its sorted CSV files and back, found by column name."""
    panel = facts.daily_work_panel(facts.FactSources(bridge.daily_work(), bridge.assets(), TIE_BREAK), AS_OF)
    folder = shared_folder(bridge.spark, "facts")
    write_facts(panel, folder)
    return read_csv(bridge.spark, folder, panel.schema)


def valid_ids_from_list(bridge: Bridge) -> DataFrame:
    """The valid list as a file with a header, as a fact job would read it."""
    folder = shared_folder(bridge.spark, "valid")
    write_csv(screening.valid_assets(screen_status_table(bridge)), folder)
    return read_id_list(bridge.spark, folder, header=True)


def sink_error_codes(bridge: Bridge) -> DataFrame:
    return sunk(ref.asset_error_codes(bridge.error_events()), schemas.ASSET_ERROR_CODES, "asset_error_codes")


OPTION_QUERIES: dict[str, Query] = {
    "facts_other_windows": bridge_query(other_windows),
    "codes_without_listed": bridge_query(codes_without_listed),
    "devices_from_master": bridge_query(devices_from_master),
    "facts_without_devices": bridge_query(no_devices),
    "sink_service_requests": bridge_query(sink_service_requests),
    "sink_error_codes": bridge_query(sink_error_codes),
    "facts_from_csv": bridge_query(facts_from_csv),
    "valid_ids_from_list": bridge_query(valid_ids_from_list),
    # The master that holds the assets of the rows, so that nearly all find theirs.
    "periodic_work_own_master": bridge_query(lambda b: ref.periodic_work(b.screen_work(), b.screen_assets(), "inner")),
    "technician_history_own_master": bridge_query(
        lambda b: ref.technician_history(b.field_activity(), b.service_orders(), b.screen_assets(), "inner")
    ),
}


FACT_QUERIES |= {"operational_age": bridge_query(operational_age), "row_change": bridge_query(row_change)}


def all_queries() -> dict[str, Query]:
    return {**FACT_QUERIES, **FILTER_QUERIES, **OPTION_QUERIES, **FLEET_QUERIES, **SCREEN_QUERIES, **REFERENCE_QUERIES, **MODEL_QUERIES}
