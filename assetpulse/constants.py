"""Column names shared by all modules, and values fixed by the data model."""

ASSET = "customer_asset_identifier"
DATE = "date"

# ---- Fixed values: stated by the data model, not tunable design choices ----

PM_CATEGORY = "Preventative Maintenance"

# Service requests of these categories are not failures.
NON_FAILURE_CATEGORIES = [
    "Preventative Maintenance",
    "Log Collection/Configuration",
    "Installation/Integration",
    "Cleaning Supplies",
    "Misrouted Call",
    "Welcome Call",
    "Serial Number Wrong",
]

# Error-code groups counted per day: code type x criticality, and single codes.
CODE_TYPES = [1]
CRITICALITIES = [1, 2, 3]
LISTED_CODES = [160, 177, 12, 74, 64, 182, 307, 306, 310, 305, 312]

# Alternative code lists.
LISTED_CODES_SHORT = [160, 177, 12, 74, 64, 182]
CRITICALITIES_SHORT = [1, 2]

# Error codes that stand for a failure when the label is taken from codes.
FAILURE_CODES = [2, 36, 47, 53, 59, 64, 74, 82, 116, 125, 135, 198, 205, 207, 213, 250, 295, 310]

DEVICE_COLUMNS = [
    "model_name",
    "model_group_id",
    "model_group_name",
    "category_id",
    "category_name",
    "type_id",
    "type_name",
    "capacity",
    "security_type",
]

ZERO_DATE = "0000-00-00 00:00:00"

# Life-event codes and values.
STATUS_EVENT = 2
STATUS_ACTIVE = 1
LOG_EVENT = 3
LOG_DAILY = 1
LOG_MANUAL = 2
FIRMWARE_EVENT = 4

REASONS = {
    1: "Not active now",
    2: "Log status manual",
    3: "Log status daily but no data for the last 15 days",
    4: "Less than the last 60 days of daily work",
    5: "Install date in the future",
}

# Columns compared by the row-change test.
CHANGE_COLUMNS = [
    "age",
    "last_pm_date",
    "notes_in",
    "notes_in_last_pm",
    "CodeType_1_criticality_1",
    "CodeType_1_criticality_1_std",
    "CodeType_1_criticality_2",
    "CodeType_1_criticality_2_std",
    "Code_160",
    "Code_160_std",
    "Code_177",
    "Code_177_std",
    "Code_12",
    "Code_12_std",
    "Code_74",
    "Code_74_std",
    "Code_64",
    "Code_64_std",
    "Code_182",
    "Code_182_std",
]
CHANGE_DISTANCE = 0.05

# Cutoff bands drawn on the curves.
MODEL_CUTOFFS = {"red": 0.74, "orange": 0.70, "yellow": 0.65}
BASELINE_CUTOFFS = {"red": 130000.0, "orange": 100000.0}

# Misclassification cost per confusion-matrix cell.
COST = {"tn": 0, "fp": 1, "fn": 2, "tp": -1}

SOURCE_TABLES = [
    "service_request_record",
    "firmware_history",
    "asset_conditions_events",
    "asset_daily_work",
    "asset_features",
    "asset_ib_info",
    "service_order_record",
    "field_service_ops_activity_record",
    "site_record",
    "company_record",
    "mapping_code_failure_mapping",
]
