"""Reference tables built from the operational tables, and the small SQL reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.constants import ASSET, DATE
from assetpulse.operators.filters import unknown_status
from assetpulse.operators.joins import not_in, restrict_to

CUSTOMER = 1
LOG_DESCRIPTIONS = ["Manually", "Daily"]


def service_request_history(requests: DataFrame, customer_id: int = CUSTOMER) -> DataFrame:
    return requests.select(
        ASSET,
        "service_request_date",
        "incident_category",
        F.col("status").alias("incident_status"),
        F.lit(customer_id).alias("customer_id"),
        F.col("serial_number").alias("Asset_serial_number"),
        F.col("priority").alias("Priority"),
    )


def asset_information(source: DataFrame) -> DataFrame:
    return source.select(
        ASSET,
        "install_date",
        "model_name",
        "model_group_id",
        "category_id",
        "type_id",
        "capacity",
        "attribute_reference",
        "customer_id",
        "Asset_serial_number",
        "location_name",
        "end_customer",
        "service_provider",
    )


def error_code_feature_def(source: DataFrame) -> DataFrame:
    return source.select(
        "customer_id",
        "code_id",
        "priority",
        "code_type",
        "description",
        "machine_code",
        "include_in_priority_group",
    )


def error_code_rows(events: DataFrame) -> DataFrame:
    return events.select("partner_id", ASSET, "serial_number", DATE, "code_id")


def asset_error_codes(events: DataFrame, customer_id: int = CUSTOMER) -> DataFrame:
    """Occurrences of each code per asset and day, repeated source rows counted once.

    The duplicate removal is keyed by the whole row and combines before the shuffle, so one busy
    (asset, day, code) is spread over many tasks before it is counted.
    """
    rows = events.drop("time", "code_type", "criticality", "description").distinct()
    return (
        rows.groupBy(ASSET, DATE, "code_id")
        .agg(F.min("serial_number").alias("asset_serial_number"), F.count("*").alias("value"))
        .select(F.lit(customer_id).alias("customer_id"), ASSET, "asset_serial_number", DATE, "code_id", "value")
    )


def periodic_work(work: DataFrame, assets: DataFrame, how: str = "left", customer_id: int = CUSTOMER) -> DataFrame:
    """Work rows with the serial number from the asset master; how='inner' drops unknown assets."""
    joined = work.select(ASSET, DATE, "working_unit").join(assets.select(ASSET, "serial_number"), ASSET, how)
    return joined.select(
        F.col("serial_number").alias("asset_serial_number"),
        ASSET,
        F.lit(customer_id).alias("customer_id"),
        DATE,
        F.lit(1).alias("work_id"),
        F.lit("Daily notes").alias("work_type"),
        F.col("working_unit").alias("work_units"),
    )


def technician_history(
    activity: DataFrame, orders: DataFrame, assets: DataFrame, how: str = "left", customer_id: int = CUSTOMER
) -> DataFrame:
    """Field visits with their order, and the asset's serial number; how applies to the asset join."""
    visits = activity.join(orders, activity.field_service_order_id == orders.id)
    return visits.join(assets.select(ASSET, "serial_number"), ASSET, how).select(
        F.lit(customer_id).alias("customer_id"),
        ASSET,
        F.col("serial_number").alias("asset_serial_number"),
        F.col("service_order_created_on").alias("serial_order_date"),
        "service_provider",
        F.col("field_technician_id").cast("int").alias("technician_id"),
        F.col("field_technician").alias("technician_name"),
        F.col("date_arrival").alias("technician_arrival_date"),
    )


def total_assets(assets: DataFrame) -> DataFrame:
    return assets.agg(F.countDistinct(ASSET).alias("assets"))


def assets_with_work_count(work: DataFrame, assets: DataFrame) -> DataFrame:
    """Known assets that have work. Ids are made distinct first, so the join sees one row per asset."""
    return restrict_to(work.select(ASSET).distinct(), assets.select(ASSET)).agg(F.count(ASSET).alias("assets"))


def assets_with_log_status(life_events: DataFrame, assets: DataFrame, code: int = 3) -> DataFrame:
    logged = life_events.filter(
        (F.col("life_event_code").cast("int") == code) & F.col("life_event_description").isin(LOG_DESCRIPTIONS)
    )
    return restrict_to(logged.select(ASSET).distinct(), assets.select(ASSET)).agg(F.count(ASSET).alias("assets"))


def assets_of_unknown_status(assets: DataFrame) -> DataFrame:
    return unknown_status(assets)


def orders_without_activity(orders: DataFrame, activity: DataFrame) -> DataFrame:
    return not_in(orders.select("id"), "id", activity, "field_service_order_id").agg(F.count("*").alias("orders"))


def work_coverage(work: DataFrame) -> DataFrame:
    return work.agg(F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"))
