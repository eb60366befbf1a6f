"""Explicit schemas: inputs are never inferred, sink tables are declared with nullability and lengths."""

from __future__ import annotations

from pyspark.sql import types as T

from assetpulse.constants import ASSET


def _fields(spec: str) -> T.StructType:
    """Schema from 'name type[!]' items; '!' marks a column that must not be null."""
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        required = kind.endswith("!")
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not required))
    return T.StructType(fields)


_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}

ASSETS = _fields(
    f"{ASSET} long, installed_date date, active_status string, product_identifier long, serial_number string, partner_id int"
)
DAILY_WORK = _fields(f"{ASSET} long, date date, working_unit long")
SERVICE_REQUESTS = _fields(
    f"{ASSET} long, service_request_date date, incident_category string, status string, priority string, serial_number string"
)
ERROR_EVENTS = _fields(
    f"{ASSET} long, serial_number string, partner_id int, date date, time string, code_id int, code_type int, criticality int, description string"
)
ASSET_FEATURES = _fields(
    "product_identifier long, model_name string, model_group_id int, model_group_name string, category_id int, "
    "category_name string, type_id int, type_name string, capacity int, security_type string"
)
FIRMWARE_HISTORY = _fields(f"{ASSET} long, firmware_version_id int, created_date string")
LIFE_EVENTS = _fields(
    f"{ASSET} long, date date, life_event_code int, life_event_value int, life_event_description string"
)
SERVICE_ORDERS = _fields(f"id long, {ASSET} long, service_order_created_on date, service_provider int")
FIELD_ACTIVITY = _fields(
    "field_service_order_id long, field_technician_id double, field_technician string, date_arrival string"
)
OPERATIONAL_DAYS = _fields("id long, day int, operational_hours double")
SECURITY_MAP = _fields("security_type string, id int")
MODEL_MAP = _fields("model_name string, id int")
VALID_ASSETS = _fields("id long")


def _sink(*columns: tuple) -> T.StructType:
    """Sink schema from (name, type) or (name, length) pairs; every sink column is not null."""
    fields = []
    for name, kind in columns:
        if isinstance(kind, int):
            fields.append(T.StructField(name, T.StringType(), False, {"max_length": kind}))
        else:
            fields.append(T.StructField(name, kind, False))
    return T.StructType(fields)


_LONG, _INT = T.LongType(), T.IntegerType()

# Declared reference tables; strings carry their maximum length.
SERVICE_REQUEST_HISTORY = _sink(
    (ASSET, _LONG),
    ("service_request_date", 10),
    ("incident_category", 30),  # the longest fixed category has 28 characters
    ("incident_status", 10),
    ("customer_id", _INT),
    ("Asset_serial_number", 15),
    ("Priority", 10),
)
PERIODIC_WORK = _sink(
    ("asset_serial_number", 15),
    (ASSET, _LONG),
    ("customer_id", _INT),
    ("date", 10),
    ("work_id", _INT),
    ("work_type", 20),
    ("work_units", _LONG),
)
TECHNICIAN_HISTORY = _sink(
    ("customer_id", _INT),
    (ASSET, _LONG),
    ("asset_serial_number", 15),
    ("serial_order_date", 10),
    ("service_provider", _INT),
    ("technician_id", _INT),
    ("technician_name", 30),
    ("technician_arrival_date", 30),
)
ASSET_ERROR_CODES = _sink(
    ("customer_id", _INT),
    (ASSET, _LONG),
    ("asset_serial_number", 15),
    ("date", 10),
    ("code_id", _INT),
    ("value", _LONG),
)
ERROR_CODE_FEATURE_DEF = _sink(
    ("customer_id", _INT),
    ("code_id", _INT),
    ("priority", _INT),
    ("code_type", _INT),
    ("description", 100),
    ("machine_code", 15),
    ("include_in_priority_group", _INT),
)
ASSET_INFORMATION = _sink(
    (ASSET, _LONG),
    ("install_date", 10),
    ("model_name", 45),
    ("model_group_id", _INT),
    ("category_id", _INT),
    ("type_id", _INT),
    ("capacity", _INT),
    ("attribute_reference", 45),
    ("customer_id", _INT),
    ("Asset_serial_number", 45),
    ("location_name", 45),
    ("end_customer", 45),
    ("service_provider", 45),
)
