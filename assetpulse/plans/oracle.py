"""DuckDB SQL for the registered queries, written by another route than the Spark plans.

Spark computes states on change days and expands them; the SQL builds the dense calendar first and uses
dense row windows and correlated lookups on it.
"""

from __future__ import annotations

AS_OF = "DATE '2001-06-30'"
SCREEN_AS_OF = "DATE '2024-01-30'"
TRAIN_END = "DATE '2001-04-30'"
TEST_END = "DATE '2001-05-30'"
TIE = "l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, l_quantity AS quantity, l_extendedprice AS price"

# name -> (names it needs, SQL)
_CTES: dict[str, tuple[list[str], str]] = {
    "assets": (
        [],
        """SELECT s_suppkey AS customer_asset_identifier,
                  DATE '1995-01-01' + CAST(s_suppkey * 37 % 2500 AS INTEGER) AS installed_date,
                  CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS active_status,
                  CAST(s_nationkey AS BIGINT) AS product_identifier,
                  'SN-' || s_suppkey AS serial_number,
                  1 + s_nationkey % 3 AS partner_id
           FROM supplier""",
    ),
    "work_rows": (
        [],
        f"""SELECT l_suppkey AS customer_asset_identifier, CAST(l_shipdate AS DATE) AS date,
                  CAST(l_quantity AS BIGINT) AS working_unit, {TIE}
           FROM lineitem WHERE l_returnflag = 'N'""",
    ),
    "daily_work": (
        ["work_rows"],
        f"""SELECT customer_asset_identifier, date, working_unit
           FROM (SELECT *, row_number() OVER (PARTITION BY customer_asset_identifier, date
                     ORDER BY order_id DESC, line DESC, part_id DESC, quantity DESC, price DESC) AS rn
                 FROM work_rows WHERE date <= {AS_OF})
           WHERE rn = 1""",
    ),
    "requests": (
        [],
        """SELECT l_suppkey AS customer_asset_identifier, CAST(l_shipdate AS DATE) AS service_request_date,
                  CASE WHEN l_returnflag = 'A' AND l_quantity <= 4 THEN 'Preventative Maintenance'
                       WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 'Hardware Fault'
                       WHEN l_returnflag = 'R' AND l_quantity >= 46 THEN 'Paper Jam'
                       WHEN l_returnflag = 'A' AND l_quantity BETWEEN 5 AND 10 THEN 'Cleaning Supplies'
                       WHEN l_returnflag = 'A' THEN CASE CAST(l_quantity AS INTEGER) % 6
                           WHEN 0 THEN 'Log Collection/Configuration' WHEN 1 THEN 'Installation/Integration'
                           WHEN 2 THEN 'Misrouted Call' WHEN 3 THEN 'Welcome Call' WHEN 4 THEN 'Serial Number Wrong' END
                  END AS incident_category,
                  l_linestatus AS status, CAST(l_linenumber AS VARCHAR) AS priority, 'SN-' || l_suppkey AS serial_number
           FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
    ),
    "pm": (
        ["requests", "assets"],
        f"""SELECT DISTINCT r.customer_asset_identifier, service_request_date AS day
           FROM requests r JOIN assets a ON a.customer_asset_identifier = r.customer_asset_identifier
           WHERE incident_category = 'Preventative Maintenance'
             AND service_request_date BETWEEN installed_date AND {AS_OF}""",
    ),
    "failures": (
        ["requests", "assets"],
        f"""SELECT r.customer_asset_identifier, service_request_date AS day, CAST(count(*) AS BIGINT) AS n
           FROM requests r JOIN assets a ON a.customer_asset_identifier = r.customer_asset_identifier
           WHERE incident_category IN ('Hardware Fault', 'Paper Jam')
             AND service_request_date BETWEEN installed_date AND {AS_OF}
           GROUP BY 1, 2""",
    ),
    "events_all": (
        [],
        """SELECT l_suppkey AS customer_asset_identifier, 'SN-' || l_suppkey AS serial_number,
                  CAST(1 + l_suppkey % 3 AS INTEGER) AS partner_id, CAST(l_shipdate AS DATE) AS date,
                  CAST(l_partkey % 320 AS INTEGER) AS code_id,
                  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS code_type,
                  1 + l_linenumber % 3 AS criticality, l_orderkey AS order_id
           FROM lineitem""",
    ),
    "features": (
        [],
        """SELECT CAST(n_nationkey AS BIGINT) AS product_identifier, n_name AS model_name,
                  n_regionkey AS model_group_id, r_name AS model_group_name, n_regionkey % 2 AS category_id,
                  'CATEGORY_' || (n_regionkey % 2) AS category_name, n_nationkey % 4 AS type_id,
                  'TYPE_' || (n_nationkey % 4) AS type_name, 100 * (n_nationkey + 1) AS capacity,
                  'SECURITY_' || (n_nationkey % 3) AS security_type
           FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "firmware": (
        [],
        f"""SELECT customer_asset_identifier, day, version FROM (
             SELECT l_suppkey AS customer_asset_identifier, CAST(l_shipdate AS DATE) AS day, l_linenumber AS version,
                    row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                        ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
             FROM lineitem
             WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity = 25 AND CAST(l_shipdate AS DATE) <= {AS_OF})
           WHERE rn = 1""",
    ),
    "bounds": (
        ["assets", "daily_work"],
        f"""SELECT a.customer_asset_identifier, a.installed_date, a.product_identifier,
                  greatest(min(w.date), a.installed_date) AS start_date
           FROM assets a JOIN daily_work w ON w.customer_asset_identifier = a.customer_asset_identifier
           GROUP BY 1, 2, 3 HAVING greatest(min(w.date), a.installed_date) <= {AS_OF}""",
    ),
    "spine": (
        ["bounds"],
        f"""SELECT customer_asset_identifier, installed_date, product_identifier, start_date,
                  CAST(unnest(generate_series(start_date, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date
           FROM bounds""",
    ),
    "worked": (
        ["spine", "daily_work"],
        """SELECT s.*, coalesce(w.working_unit, 0) AS working_unit
           FROM spine s LEFT JOIN daily_work w
             ON w.customer_asset_identifier = s.customer_asset_identifier AND w.date = s.date""",
    ),
    "work_sums": (
        ["worked"],
        """SELECT *,
             CAST(sum(working_unit) OVER (PARTITION BY customer_asset_identifier ORDER BY date
                  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS notes_in,
             CAST(sum(working_unit) OVER (PARTITION BY customer_asset_identifier ORDER BY date
                  ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS notes_in_last30,
             date - installed_date AS age
           FROM worked""",
    ),
    "segments": (
        ["worked", "pm"],
        """SELECT w.customer_asset_identifier, w.date, w.working_unit,
             count(p.day) OVER (PARTITION BY w.customer_asset_identifier ORDER BY w.date ROWS UNBOUNDED PRECEDING) AS segment
           FROM worked w LEFT JOIN pm p
             ON p.customer_asset_identifier = w.customer_asset_identifier AND p.day = w.date""",
    ),
    "since_pm": (
        ["segments"],
        """SELECT customer_asset_identifier, date,
             CAST(sum(working_unit) OVER (PARTITION BY customer_asset_identifier, segment ORDER BY date
                  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS notes_in_last_pm
           FROM segments""",
    ),
    "pm_days": (
        ["spine", "pm"],
        """SELECT s.customer_asset_identifier, s.date,
             s.date - coalesce(max(p.day), s.installed_date) AS last_pm_date,
             s.date - coalesce(max(p.day) FILTER (WHERE p.day >= s.start_date), s.installed_date) AS last_pm_date_from_start
           FROM spine s LEFT JOIN pm p
             ON p.customer_asset_identifier = s.customer_asset_identifier AND p.day <= s.date
           GROUP BY s.customer_asset_identifier, s.date, s.installed_date""",
    ),
    "failure_ahead": (
        ["spine", "failures"],
        """SELECT s.customer_asset_identifier, s.date, min(f.day) - s.date AS ahead
           FROM spine s LEFT JOIN failures f
             ON f.customer_asset_identifier = s.customer_asset_identifier AND f.day >= s.date
           GROUP BY s.customer_asset_identifier, s.date""",
    ),
    "labels_daily": (
        ["failure_ahead"],
        """SELECT customer_asset_identifier, date,
             CASE WHEN ahead <= 30 THEN 1 ELSE 0 END AS failure_event,
             CASE WHEN ahead < 180 THEN ahead ELSE 180 END AS day_to_failure
           FROM failure_ahead""",
    ),
    "failure_past": (
        ["spine", "failures"],
        """SELECT s.customer_asset_identifier, s.date,
             CAST(coalesce(sum(f.n), 0) AS BIGINT) AS numIncidents,
             s.date - coalesce(max(f.day), s.installed_date) AS days_Since_failure
           FROM spine s LEFT JOIN failures f
             ON f.customer_asset_identifier = s.customer_asset_identifier AND f.day <= s.date
           GROUP BY s.customer_asset_identifier, s.date, s.installed_date""",
    ),
    "firmware_daily": (
        ["spine", "firmware"],
        """SELECT s.customer_asset_identifier, s.date,
             coalesce(arg_max(f.version, f.day) FILTER (WHERE f.day <= s.date),
                      arg_min(f.version, f.day) FILTER (WHERE f.day > s.date)) AS firmwareHistory
           FROM spine s LEFT JOIN firmware f ON f.customer_asset_identifier = s.customer_asset_identifier
           GROUP BY s.customer_asset_identifier, s.date""",
    ),
}

CODE_CONDITIONS = {
    **{f"CodeType_1_criticality_{c}": f"code_type = 1 AND criticality = {c}" for c in (1, 2, 3)},
    **{f"Code_{c}": f"code_id = {c}" for c in (160, 177, 12, 74, 64, 182, 307, 306, 310, 305, 312)},
}


def _code_ctes(conditions: dict[str, str], suffix: str = "") -> None:
    counts = ", ".join(f"count(*) FILTER (WHERE {condition}) AS {name}" for name, condition in conditions.items())
    filled = ", ".join(f"coalesce(c.{name}, 0) AS {name}" for name in conditions)
    dense = ", ".join(
        f"CAST(sum({name}) OVER w AS BIGINT) AS {name}, "
        f"CASE WHEN row_number() OVER o >= 30 THEN stddev_samp({name}) OVER w END AS {name}_std"
        for name in conditions
    )
    _CTES[f"code_counts{suffix}"] = (
        ["events_all"],
        f"SELECT customer_asset_identifier, date, {counts} FROM events_all GROUP BY 1, 2",
    )
    _CTES[f"code_filled{suffix}"] = (
        ["spine", f"code_counts{suffix}"],
        f"""SELECT s.customer_asset_identifier, s.date, {filled}
            FROM spine s LEFT JOIN code_counts{suffix} c
              ON c.customer_asset_identifier = s.customer_asset_identifier AND c.date = s.date""",
    )
    _CTES[f"code_rolling{suffix}"] = (
        [f"code_filled{suffix}"],
        f"""SELECT customer_asset_identifier, date, {dense} FROM code_filled{suffix}
            WINDOW o AS (PARTITION BY customer_asset_identifier ORDER BY date),
                   w AS (PARTITION BY customer_asset_identifier ORDER BY date
                         ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    )


_code_ctes(CODE_CONDITIONS)
_code_ctes({f"CodeType_1_criticality_{c}": f"code_type = 1 AND criticality = {c}" for c in (1, 2, 3)}, "_unlisted")

DEVICE = [
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
KEY = "customer_asset_identifier, date"


def with_ctes(body: str, *names: str) -> str:
    """Prefixes the body with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in _CTES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in ordered) + "\n" + body


_CODE_SELECT = ", ".join(f"{name}, round({name}_std, 6) AS {name}_std" for name in CODE_CONDITIONS)
_FACT_PARTS = ["work_sums", "since_pm", "pm_days", "labels_daily", "failure_past", "firmware_daily", "code_rolling"]
_FACT_JOIN = "FROM work_sums " + " ".join(f"JOIN {name} USING ({KEY})" for name in _FACT_PARTS[1:])
# Plain divisions of integers are equal in both engines to the last bit; only deviations are rounded.
_AVERAGES = """CASE WHEN age <> 0 THEN CAST(notes_in AS DOUBLE) / age END AS Avg_notes_in,
    CAST(notes_in_last30 AS DOUBLE) / 30 AS Avg_notes_in_last30"""


_FACT_SELECT = f"""SELECT {KEY}, notes_in, notes_in_last30, age, {_AVERAGES}, notes_in_last_pm, last_pm_date,
      day_to_failure, numIncidents, days_Since_failure, failure_event, firmwareHistory,
      {_CODE_SELECT}, {", ".join(DEVICE)}
    {_FACT_JOIN} JOIN features USING (product_identifier)"""


def facts_sql() -> dict[str, str]:
    return {
        "daily_spine_work": with_ctes(
            f"SELECT {KEY}, working_unit, notes_in, notes_in_last30, age FROM work_sums", "work_sums"
        ),
        "work_since_pm": with_ctes(f"SELECT {KEY}, notes_in_last_pm FROM since_pm", "since_pm"),
        "days_since_pm": with_ctes(f"SELECT {KEY}, last_pm_date FROM pm_days", "pm_days"),
        "days_since_pm_from_start": with_ctes(
            f"SELECT {KEY}, last_pm_date_from_start AS last_pm_date FROM pm_days", "pm_days"
        ),
        "firmware_as_of": with_ctes(f"SELECT {KEY}, firmwareHistory FROM firmware_daily", "firmware_daily"),
        "failure_labels": with_ctes(f"SELECT {KEY}, failure_event, day_to_failure FROM labels_daily", "labels_daily"),
        "failure_labels_from_codes": with_ctes(
            f"""SELECT s.customer_asset_identifier, s.date,
                  CASE WHEN min(e.date) - s.date <= 30 THEN 1 ELSE 0 END AS failure_event
                FROM spine s LEFT JOIN (
                    SELECT DISTINCT customer_asset_identifier, date FROM events_all
                    WHERE code_id IN (2, 36, 47, 53, 59, 64, 74, 82, 116, 125, 135, 198, 205, 207, 213, 250, 295, 310)
                      AND date <= {AS_OF}) e
                  ON e.customer_asset_identifier = s.customer_asset_identifier AND e.date >= s.date
                GROUP BY s.customer_asset_identifier, s.date""",
            "spine",
            "events_all",
        ),
        "incident_history": with_ctes(
            f"SELECT {KEY}, numIncidents, days_Since_failure FROM failure_past", "failure_past"
        ),
        "age_and_averages": with_ctes(f"SELECT {KEY}, age, {_AVERAGES} FROM work_sums", "work_sums"),
        "code_rolling_features": with_ctes(f"SELECT {KEY}, {_CODE_SELECT} FROM code_rolling", "code_rolling"),
        "daily_facts": with_ctes(_FACT_SELECT, *_FACT_PARTS, "features"),
    }


_CTES.update(
    {
        "s_assets": (
            [],
            """SELECT c_custkey AS customer_asset_identifier,
                  DATE '2023-12-20' + CAST(c_custkey % 45 AS INTEGER) AS installed_date,
                  CASE WHEN c_acctbal < 0 THEN 'Inactive' WHEN c_acctbal > 9500 THEN 'Unknown' ELSE 'Active' END AS active_status,
                  CAST(c_nationkey AS BIGINT) AS product_identifier, 'SN-' || c_custkey AS serial_number, 1 AS partner_id
               FROM customer""",
        ),
        "s_work": (
            [],
            "SELECT user_id AS customer_asset_identifier, CAST(ts AS DATE) AS date, event_id FROM events",
        ),
        "s_universe": (["s_work"], "SELECT DISTINCT customer_asset_identifier FROM s_work"),
        "s_life": (
            [],
            """SELECT o_custkey AS customer_asset_identifier, CAST(o_orderdate AS DATE) AS date,
                  CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS life_event_code,
                  CASE WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'F' THEN 2
                       WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS life_event_value,
                  CASE WHEN o_orderstatus = 'O' THEN 'Daily' WHEN o_orderstatus = 'F' THEN 'Manually'
                       ELSE 'Status' END AS life_event_description
               FROM orders""",
        ),
        "s_inactive": (
            ["s_life", "s_universe"],
            """SELECT DISTINCT customer_asset_identifier FROM s_life JOIN s_universe USING (customer_asset_identifier)
               WHERE life_event_code = 2 AND life_event_value IS DISTINCT FROM 1""",
        ),
        "s_active": (
            ["s_life", "s_universe"],
            """SELECT DISTINCT customer_asset_identifier FROM s_life JOIN s_universe USING (customer_asset_identifier)
               WHERE life_event_code = 2 AND life_event_value = 1""",
        ),
        "s_daily": (
            ["s_life", "s_universe"],
            """SELECT DISTINCT customer_asset_identifier FROM s_life JOIN s_universe USING (customer_asset_identifier)
               WHERE life_event_code = 3 AND life_event_value = 1""",
        ),
        "s_manual": (
            ["s_life", "s_universe"],
            """SELECT DISTINCT customer_asset_identifier FROM s_life JOIN s_universe USING (customer_asset_identifier)
               WHERE life_event_code = 3 AND life_event_value = 2""",
        ),
        "s_manual_only": (["s_manual", "s_daily"], "SELECT * FROM s_manual EXCEPT SELECT * FROM s_daily"),
        "s_daily_only": (["s_manual", "s_daily"], "SELECT * FROM s_daily EXCEPT SELECT * FROM s_manual"),
        "s_both": (["s_manual", "s_daily"], "SELECT * FROM s_daily INTERSECT SELECT * FROM s_manual"),
        "s_steps": (
            ["s_work"],
            """SELECT customer_asset_identifier, date, event_id,
                  lead(date) OVER w - date AS step,
                  count(*) OVER w AS position
               FROM s_work WINDOW w AS (PARTITION BY customer_asset_identifier ORDER BY date, event_id)""",
        ),
        # Run length of irregular steps ending at a row: its position less that of the latest regular step.
        "s_runs": (
            ["s_steps"],
            """SELECT customer_asset_identifier, step,
                  CASE WHEN step <> 1 THEN position - coalesce(max(CASE WHEN step = 1 THEN position END)
                      OVER (PARTITION BY customer_asset_identifier ORDER BY position ROWS UNBOUNDED PRECEDING), 0)
                  ELSE 0 END AS run
               FROM s_steps""",
        ),
        "s_irregular": (
            ["s_runs"],
            "SELECT customer_asset_identifier FROM s_runs GROUP BY 1 HAVING max(run) > 6",
        ),
        "s_gap": (
            ["s_runs"],
            "SELECT customer_asset_identifier FROM s_runs GROUP BY 1 HAVING max(step) > 2",
        ),
        "s_few": (
            ["s_work"],
            "SELECT customer_asset_identifier FROM s_work GROUP BY 1 HAVING count(*) <= 60",
        ),
        "s_future": (
            ["s_assets"],
            f"SELECT customer_asset_identifier FROM s_assets WHERE installed_date > {SCREEN_AS_OF}",
        ),
        "s_errors": (
            ["s_inactive", "s_manual_only", "s_irregular", "s_few", "s_future"],
            """SELECT customer_asset_identifier, 1 AS reason_id FROM s_inactive
               UNION ALL SELECT customer_asset_identifier, 2 FROM s_manual_only
               UNION ALL SELECT customer_asset_identifier, 3 FROM s_irregular
               UNION ALL SELECT customer_asset_identifier, 4 FROM s_few
               UNION ALL SELECT customer_asset_identifier, 5 FROM s_future""",
        ),
        "s_error_ids": (
            ["s_errors", "s_universe"],
            "SELECT * FROM s_universe INTERSECT SELECT customer_asset_identifier FROM s_errors",
        ),
        "s_valid": (
            ["s_errors", "s_universe"],
            "SELECT * FROM s_universe EXCEPT SELECT customer_asset_identifier FROM s_errors",
        ),
        "m_inactive": (
            ["s_assets", "s_universe"],
            """SELECT customer_asset_identifier FROM s_assets JOIN s_universe USING (customer_asset_identifier)
               WHERE active_status IS DISTINCT FROM 'Active'""",
        ),
        "m_errors": (
            ["m_inactive", "s_manual_only", "s_irregular", "s_few", "s_future", "s_universe"],
            """SELECT customer_asset_identifier, 1 AS reason_id FROM m_inactive
               UNION ALL SELECT customer_asset_identifier, 2 FROM s_manual_only
               UNION ALL SELECT customer_asset_identifier, 3 FROM s_irregular
               UNION ALL SELECT customer_asset_identifier, 4 FROM s_few
               UNION ALL SELECT customer_asset_identifier, 5 FROM s_future JOIN s_universe USING (customer_asset_identifier)""",
        ),
    }
)

_MATRIX = {
    "daily_notes_present": "s_universe",
    "selected_for_ML": "s_valid",
    "error_log": "s_error_ids",
    "install_date_in_future": "s_future",
    "daily_work_for_60days": "(SELECT customer_asset_identifier FROM s_universe EXCEPT SELECT * FROM s_few)",
    "no_daily_work_for_60_days": "s_few",
    "work_missing_for_15_consecutive_days": "s_irregular",
    "perfect_daily_work": "(SELECT customer_asset_identifier FROM s_universe EXCEPT SELECT * FROM s_irregular)",
    "Log status 1": "s_daily_only",
    "Log 1&2": "s_both",
    "Log 2": "s_manual_only",
    "Active Asset": "(SELECT customer_asset_identifier FROM s_assets WHERE active_status = 'Active')",
    "inactive Asset": "(SELECT customer_asset_identifier FROM s_assets WHERE active_status = 'Inactive')",
}


def screening_sql() -> dict[str, str]:
    def reasons(table: str, reason: int) -> str:
        return with_ctes(f"SELECT customer_asset_identifier, {reason} AS reason_id FROM {table}", table)

    flags = ", ".join(
        f'CAST(a.customer_asset_identifier IN (SELECT customer_asset_identifier FROM {source}) AS BIGINT) AS "{name}"'
        for name, source in _MATRIX.items()
    )
    sums = ", ".join(f'CAST(sum("{name}") AS BIGINT) AS "{name}"' for name in _MATRIX)
    metrics = {
        "assets with daily work": "s_universe",
        "active assets": "s_active",
        "inactive assets": "s_inactive",
        "daily log only": "s_daily_only",
        "manual log only": "s_manual_only",
        "daily log": "s_daily",
        "missing work": "s_irregular",
        "perfect work": "(SELECT * FROM s_universe EXCEPT SELECT * FROM s_irregular)",
        "enough work": "(SELECT * FROM s_universe EXCEPT SELECT * FROM s_few)",
        "too little work": "s_few",
        "future install": "s_future",
        "in error log": "s_error_ids",
        "passing all filters": "s_valid",
    }
    summary = " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, CAST(count(*) AS BIGINT) AS value FROM {source}" for metric, source in metrics.items()
    )
    all_names = [
        "s_universe", "s_active", "s_inactive", "s_daily_only", "s_manual_only", "s_daily", "s_both",
        "s_irregular", "s_few", "s_future", "s_error_ids", "s_valid", "s_assets",
    ]
    pick = """SELECT customer_asset_identifier FROM s_assets
              ORDER BY md5('42:' || customer_asset_identifier), customer_asset_identifier LIMIT 1"""
    return {
        "screen_status": reasons("s_inactive", 1),
        "screen_status_master": reasons("m_inactive", 1),
        "screen_log": reasons("s_manual_only", 2),
        "screen_irregular": reasons("s_irregular", 3),
        "screen_gap": with_ctes("SELECT customer_asset_identifier FROM s_gap", "s_gap"),
        "screen_volume": reasons("s_few", 4),
        "screen_install": reasons("s_future", 5),
        "error_log": with_ctes("SELECT * FROM s_errors", "s_errors"),
        "error_log_master": with_ctes("SELECT * FROM m_errors", "m_errors"),
        "valid_assets": with_ctes("SELECT customer_asset_identifier AS id FROM s_valid", "s_valid"),
        "valid_assets_master": with_ctes(
            """SELECT customer_asset_identifier AS id FROM s_assets
               WHERE customer_asset_identifier NOT IN (SELECT customer_asset_identifier FROM m_errors)""",
            "s_assets",
            "m_errors",
        ),
        "screening_summary": with_ctes(summary, *all_names),
        "reason_matrix": with_ctes(
            f"""SELECT * FROM (SELECT a.customer_asset_identifier AS product_id, {flags} FROM s_assets a)
                UNION ALL SELECT NULL, {sums} FROM (SELECT {flags} FROM s_assets a)""",
            *all_names,
        ),
        "asset_spot_check": with_ctes(
            f"""SELECT 'info' AS section, a.customer_asset_identifier, CAST(installed_date AS VARCHAR) AS detail, CAST(1 AS BIGINT) AS n
                FROM s_assets a WHERE a.customer_asset_identifier IN ({pick})
                UNION ALL
                SELECT 'life event', customer_asset_identifier, life_event_description, count(*)
                FROM s_life WHERE customer_asset_identifier IN ({pick}) GROUP BY ALL
                UNION ALL
                SELECT 'error', customer_asset_identifier, CAST(reason_id AS VARCHAR), count(*)
                FROM s_errors WHERE customer_asset_identifier IN ({pick}) GROUP BY ALL""",
            "s_assets",
            "s_life",
            "s_errors",
        ),
    }


def reference_sql() -> dict[str, str]:
    technician = """SELECT 1 AS customer_id, o.o_custkey AS customer_asset_identifier, a.serial_number AS asset_serial_number,
            CAST(o.o_orderdate AS DATE) AS serial_order_date, CAST(1 + o.o_orderkey % 5 AS INTEGER) AS service_provider,
            CASE WHEN l.l_quantity > 1 THEN CAST(l.l_suppkey AS INTEGER) END AS technician_id,
            'Technician ' || l.l_suppkey AS technician_name, strftime(l.l_shipdate, '%Y-%m-%d') AS technician_arrival_date
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
        {join} JOIN assets a ON a.customer_asset_identifier = o.o_custkey"""
    periodic = """SELECT a.serial_number AS asset_serial_number, w.customer_asset_identifier, 1 AS customer_id, w.date,
            1 AS work_id, 'Daily notes' AS work_type, w.working_unit AS work_units
        FROM (SELECT user_id AS customer_asset_identifier, CAST(ts AS DATE) AS date, CAST(trunc(value) AS BIGINT) AS working_unit FROM events) w
        {join} JOIN assets a ON a.customer_asset_identifier = w.customer_asset_identifier"""
    return {
        "service_request_history": with_ctes(
            """SELECT customer_asset_identifier, service_request_date, incident_category, status AS incident_status,
                  1 AS customer_id, serial_number AS "Asset_serial_number", priority AS "Priority"
               FROM requests""",
            "requests",
        ),
        "asset_information": """
            SELECT c_custkey AS customer_asset_identifier,
                strftime(DATE '2023-12-20' + CAST(c_custkey % 45 AS INTEGER), '%Y-%m-%d') AS install_date,
                c_mktsegment AS model_name, n_regionkey AS model_group_id, n_regionkey % 2 AS category_id,
                n_nationkey % 4 AS type_id, 100 * (n_nationkey + 1) AS capacity,
                'REF-' || c_nationkey AS attribute_reference, 1 AS customer_id,
                'SN-' || c_custkey AS "Asset_serial_number", n_name AS location_name, c_name AS end_customer,
                'PROVIDER_' || n_regionkey AS service_provider
            FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "error_code_feature_def": """
            SELECT 1 AS customer_id, CAST(p_partkey AS INTEGER) AS code_id, p_size % 5 AS priority,
                1 + p_size % 2 AS code_type, p_name AS description, p_brand AS machine_code,
                CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS include_in_priority_group
            FROM part""",
        "error_code_rows": with_ctes(
            "SELECT partner_id, customer_asset_identifier, serial_number, date, code_id FROM events_all", "events_all"
        ),
        "asset_error_codes": with_ctes(
            """SELECT 1 AS customer_id, customer_asset_identifier, max(serial_number) AS asset_serial_number, date,
                  code_id, CAST(count(DISTINCT order_id) AS BIGINT) AS value
               FROM events_all GROUP BY customer_asset_identifier, date, code_id""",
            "events_all",
        ),
        "periodic_work_left": with_ctes(periodic.format(join="LEFT"), "assets"),
        "periodic_work_inner": with_ctes(periodic.format(join="INNER"), "assets"),
        "technician_history_left": with_ctes(technician.format(join="LEFT"), "assets"),
        "technician_history_inner": with_ctes(technician.format(join="INNER"), "assets"),
        "total_assets": "SELECT count(DISTINCT c_custkey) AS assets FROM customer",
        "assets_with_work_count": """
            SELECT count(DISTINCT user_id) AS assets FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""",
        "assets_with_log_status": with_ctes(
            """SELECT count(DISTINCT customer_asset_identifier) AS assets FROM s_life
               WHERE customer_asset_identifier IN (SELECT c_custkey FROM customer)
                 AND life_event_code = 3 AND life_event_description IN ('Manually', 'Daily')""",
            "s_life",
        ),
        "unknown_status": with_ctes(
            "SELECT * FROM s_assets WHERE active_status NOT IN ('Active', 'Inactive')", "s_assets"
        ),
        "orders_without_activity": """
            SELECT count(*) AS orders FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
        "work_coverage": with_ctes(
            "SELECT min(date) AS first_date, max(date) AS last_date FROM work_rows", "work_rows"
        ),
    }


_CTES.update(
    {
        "report": (
            ["labels_daily", "since_pm", "failure_past"],
            f"""SELECT date, customer_asset_identifier, failure_event, notes_in_last_pm, day_to_failure, days_Since_failure,
                  least(days_Since_failure / 365.0::DOUBLE, 1.0::DOUBLE) AS mdl_pred
                FROM labels_daily JOIN since_pm USING ({KEY}) JOIN failure_past USING ({KEY})
                WHERE date > {TRAIN_END} AND date <= {TEST_END}""",
        ),
        # Mean rank of ties: rows below plus half of the equal rows and a half.
        "ranked": (
            ["report"],
            """SELECT a.date, a.customer_asset_identifier,
                  count(*) FILTER (WHERE b.notes_in_last_pm < a.notes_in_last_pm)
                  + (count(*) FILTER (WHERE b.notes_in_last_pm = a.notes_in_last_pm) + 1) / 2.0::DOUBLE AS rnk
               FROM report a JOIN report b ON a.date = b.date GROUP BY 1, 2""",
        ),
        "baseline": (
            ["ranked", "report"],
            f"""SELECT r.*, rnk / (SELECT max(rnk) FROM ranked) AS pctl_bl FROM report r JOIN ranked USING ({KEY})""",
        ),
        "items": (
            ["baseline"],
            """SELECT 'model' AS curve, date, mdl_pred AS score, failure_event AS label FROM baseline
               UNION ALL SELECT 'baseline', date, pctl_bl, failure_event FROM baseline""",
        ),
        "curve_points": (
            ["items"],
            """SELECT curve, date, score, label, row_number() OVER w AS k,
                  sum(label) OVER (PARTITION BY curve, date ORDER BY score DESC, label DESC ROWS UNBOUNDED PRECEDING) AS hits,
                  count(*) OVER (PARTITION BY curve, date) AS n_all, sum(label) OVER (PARTITION BY curve, date) AS pos_all
               FROM items WINDOW w AS (PARTITION BY curve, date ORDER BY score DESC, label DESC)""",
        ),
    }
)


def _prepared_select() -> str:
    code_fill = ", ".join(
        f"{name}, round(coalesce({name}_std, 0), 6) AS {name}_std" for name in CODE_CONDITIONS
    )
    return f"""SELECT {KEY}, notes_in, notes_in_last30, age,
                  coalesce(CASE WHEN age <> 0 THEN CAST(notes_in AS DOUBLE) / age END, 0) AS Avg_notes_in,
                  CAST(notes_in_last30 AS DOUBLE) / 30 AS Avg_notes_in_last30, notes_in_last_pm, last_pm_date,
                  numIncidents, days_Since_failure, failure_event, coalesce(firmwareHistory, 0) AS firmwareHistory,
                  {code_fill}, n.n_nationkey + 1 AS model_name, model_group_id, category_id, type_id, capacity,
                  CASE WHEN n.n_nationkey % 3 < 2 THEN n.n_nationkey % 3 + 1 ELSE 0 END AS security_type
                {_FACT_JOIN} JOIN features f USING (product_identifier) JOIN nation n ON n.n_name = f.model_name
                WHERE date BETWEEN DATE '1998-01-01' AND {TEST_END}"""


def model_sql() -> dict[str, str]:
    metrics = """SELECT round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall,
              round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision,
              round(CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp), 6) AS accuracy,
              fp + 2 * fn - tp AS "costMatrix", '{model}' AS "Modelname"
            FROM (SELECT count(*) FILTER (WHERE NOT y AND NOT p) AS tn, count(*) FILTER (WHERE NOT y AND p) AS fp,
                         count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE y AND p) AS tp
                  FROM (SELECT {truth} AS y, {guess} AS p FROM report))"""
    bands = [
        ("model", "red", 0.74, "mdl_pred"),
        ("model", "orange", 0.70, "mdl_pred"),
        ("model", "yellow", 0.65, "mdl_pred"),
        ("baseline", "red", 1300.0, "notes_in_last_pm"),
        ("baseline", "orange", 1000.0, "notes_in_last_pm"),
    ]
    percentiles = " UNION ALL ".join(
        f"""SELECT '{curve}' AS curve, date, '{band}' AS band, {cut}::DOUBLE AS cutoff,
              (count(*) FILTER (WHERE {column} < {cut}) + count(*) FILTER (WHERE {column} <= {cut})
               + CASE WHEN count(*) FILTER (WHERE {column} = {cut}) > 0 THEN 1 ELSE 0 END) * 50.0::DOUBLE / count(*) AS percentile
            FROM report GROUP BY date"""
        for curve, band, cut, column in bands
    )
    return {
        "ml_prepared": with_ctes(_prepared_select(), *_FACT_PARTS, "features"),
        "time_split_counts": with_ctes(
            f"""SELECT 'train' AS part, count(*) AS rows FROM spine WHERE date <= {TRAIN_END}
                UNION ALL SELECT 'test', count(*) FROM spine WHERE date > {TRAIN_END} AND date <= {TEST_END}""",
            "spine",
        ),
        "baseline_score": with_ctes(
            f"SELECT {KEY}, notes_in_last_pm, round(pctl_bl, 6) AS pctl_bl FROM baseline", "baseline"
        ),
        "precision_curve": with_ctes(
            """SELECT curve, date, k, round(CAST(hits AS DOUBLE) / k, 6) AS precision,
                  round(CAST(pos_all AS DOUBLE) / n_all, 6) AS base_rate
               FROM curve_points WHERE k <= 100""",
            "curve_points",
        ),
        "precision_curve_top10": with_ctes(
            """SELECT curve, date, k, round(CAST(hits AS DOUBLE) / k, 6) AS precision,
                  round(CAST(pos_all AS DOUBLE) / n_all, 6) AS base_rate
               FROM curve_points WHERE k <= 10""",
            "curve_points",
        ),
        "gain_curve": with_ctes(
            """SELECT curve, date, k, round(CAST(k - 1 AS DOUBLE) / n_all, 6) AS x,
                  round(CAST(hits AS DOUBLE) / nullif(pos_all, 0), 6) AS y
               FROM curve_points""",
            "curve_points",
        ),
        "curve_area": with_ctes(
            """SELECT curve, date, round(sum((y + before) / 2 * (x - x_before)), 6) AS area,
                  round(sum((y + before) / 2 * (x - x_before)) - 0.5, 6) AS area_over_random
               FROM (SELECT curve, date, x, y, lag(x) OVER w AS x_before, lag(y) OVER w AS before
                     FROM (SELECT curve, date, k, CAST(k - 1 AS DOUBLE) / n_all AS x,
                                  CAST(hits AS DOUBLE) / nullif(pos_all, 0) AS y FROM curve_points)
                     WINDOW w AS (PARTITION BY curve, date ORDER BY k))
               GROUP BY curve, date""",
            "curve_points",
        ),
        "roc_auc": with_ctes(
            """SELECT curve, date, round(avg(won), 6) AS roc_auc
               FROM (SELECT i.curve, i.date,
                        CASE WHEN h.label = 1 AND i.label = 0 THEN
                          CASE WHEN h.score > i.score THEN 1.0 WHEN h.score = i.score THEN 0.5 ELSE 0.0 END END AS won
                     FROM items h JOIN items i ON h.curve = i.curve AND h.date = i.date)
               GROUP BY curve, date""",
            "items",
        ),
        "cutoff_points": with_ctes(
            f"""SELECT curve, date, band, cutoff, round(percentile, 6) AS percentile,
                  round((n - 1) * (100 - percentile) / 100 / n, 6) AS x,
                  round(ys[lo] + (ys[hi] - ys[lo]) * ((n - 1) * (100 - percentile) / 100 - (lo - 1)), 6) AS y
                FROM (SELECT *, CAST(floor((n - 1) * (100 - percentile) / 100) AS BIGINT) + 1 AS lo,
                        CAST(ceil((n - 1) * (100 - percentile) / 100) AS BIGINT) + 1 AS hi
                      FROM ({percentiles}) JOIN (
                        SELECT curve, date, max(n_all) AS n,
                          list(CAST(hits AS DOUBLE) / nullif(pos_all, 0) ORDER BY k) AS ys
                        FROM curve_points GROUP BY curve, date) USING (curve, date))""",
            "curve_points",
            "report",
        ),
        "reference_lines": with_ctes(
            """SELECT date, line, position, round(x, 6) AS x, y FROM (
                 SELECT date, 'ideal' AS line, 1 AS position, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y FROM report GROUP BY date
                 UNION ALL SELECT date, 'ideal', 2, avg(failure_event), 1.0 FROM report GROUP BY date
                 UNION ALL SELECT date, 'ideal', 3, 1.0, 1.0 FROM report GROUP BY date
                 UNION ALL SELECT date, 'random', 1, 0.0, 0.0 FROM report GROUP BY date
                 UNION ALL SELECT date, 'random', 2, 1.0, 1.0 FROM report GROUP BY date)""",
            "report",
        ),
        "classification_metrics": with_ctes(
            metrics.format(model="recent failure", truth="failure_event = 1", guess="mdl_pred <= 0.5"), "report"
        ),
        "regression_metrics": with_ctes(
            metrics.format(model="time since failure", truth="day_to_failure <= 30", guess="days_Since_failure <= 30"),
            "report",
        ),
    }


_CHANGE = ["age", "last_pm_date", "notes_in", "notes_in_last_pm"]
_CHANGE_CODES = ["CodeType_1_criticality_1", "CodeType_1_criticality_2", *[f"Code_{c}" for c in (160, 177, 12, 74, 64, 182)]]


def option_sql() -> dict[str, str]:
    names = [*_CHANGE, *_CHANGE_CODES, *[f"{name}_std" for name in _CHANGE_CODES]]
    squares = " + ".join(f"coalesce(pow({name} - lag({name}) OVER w, 2), 0)" for name in names)
    return {
        "operational_age": with_ctes(
            """SELECT s.customer_asset_identifier, s.date, s.date - s.installed_date AS age, (
                  SELECT count(*) FROM generate_series(0, s.date - s.installed_date) AS d(i)
                  WHERE (s.customer_asset_identifier + dayofweek(s.installed_date + CAST(i AS INTEGER))) % 3 <> 0
                    AND (s.customer_asset_identifier + dayofweek(s.installed_date + CAST(i AS INTEGER))) % 5 <> 0) AS operational_age
               FROM spine s""",
            "spine",
        ),
        "row_change": with_ctes(
            f"""SELECT {KEY}, round(distance, 6) AS distance, CAST(distance >= 0.05 AS INTEGER) AS changed
                FROM (SELECT {KEY}, CASE WHEN lag(age) OVER w IS NOT NULL THEN sqrt({squares}) END AS distance
                      FROM work_sums JOIN since_pm USING ({KEY}) JOIN pm_days USING ({KEY}) JOIN code_rolling USING ({KEY})
                      WINDOW w AS (PARTITION BY customer_asset_identifier ORDER BY date))""",
            "work_sums",
            "since_pm",
            "pm_days",
            "code_rolling",
        ),
    }


def filter_sql() -> dict[str, str]:
    year = "service_request_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
    reasons = {
        1: "Not active now",
        2: "Log status manual",
        3: "Log status daily but no data for the last 15 days",
        4: "Less than the last 60 days of daily work",
        5: "Install date in the future",
    }
    named = " ".join(f"WHEN {n} THEN '{text}'" for n, text in reasons.items())
    return {
        "assets_active": with_ctes("SELECT customer_asset_identifier FROM s_assets WHERE active_status = 'Active'", "s_assets"),
        "assets_not_active": with_ctes(
            "SELECT customer_asset_identifier, active_status FROM s_assets WHERE active_status IS DISTINCT FROM 'Active'", "s_assets"
        ),
        "maintenance_requests": with_ctes(
            f"SELECT *, 1 AS customer_id FROM requests WHERE incident_category = 'Preventative Maintenance' AND {year}", "requests"
        ),
        "failure_requests": with_ctes(
            f"SELECT * FROM requests WHERE incident_category IN ('Hardware Fault', 'Paper Jam') AND {year}", "requests"
        ),
        "manual_log_events": with_ctes("SELECT * FROM f_life WHERE life_event_code = 3 AND life_event_value = 2", "f_life"),
        "last_work_of_day": with_ctes("SELECT * FROM daily_work", "daily_work").replace(f" WHERE date <= {AS_OF}", ""),
        "error_log_named": with_ctes(f"SELECT customer_asset_identifier, reason_id, CASE reason_id {named} END AS reason FROM s_errors", "s_errors"),
        "visits_by_day": """SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS visits, strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS month
            FROM lineitem GROUP BY 1, 3""",
        "screen_lists": with_ctes(
            """SELECT 'valid' AS list, customer_asset_identifier AS id FROM s_valid
               UNION ALL SELECT 'error', customer_asset_identifier FROM s_error_ids
               UNION ALL SELECT 'manual', customer_asset_identifier FROM s_manual_only
               UNION ALL SELECT 'regular', customer_asset_identifier FROM (SELECT * FROM s_universe EXCEPT SELECT * FROM s_irregular)""",
            "s_valid",
            "s_error_ids",
            "s_manual_only",
            "s_irregular",
            "s_universe",
        ),
        "facts_from_csv": facts_sql()["daily_spine_work"],
        "valid_ids_from_list": screening_sql()["valid_assets"],
        "prediction_slice": with_ctes(
            "SELECT date, customer_asset_identifier, round(mdl_pred, 6) AS mdl_pred FROM report WHERE date IN (DATE '2001-05-10', DATE '2001-05-30')",
            "report",
        ),
        "score_report": with_ctes(
            """SELECT date, customer_asset_identifier, failure_event, notes_in_last_pm, round(mdl_pred, 6) AS mdl_pred
               FROM report WHERE date IN (DATE '2001-05-10', DATE '2001-05-30')""",
            "report",
        ),
    }


def variant_sql() -> dict[str, str]:
    """Options of the fact job and the declared sinks."""
    reference = reference_sql()
    weekly = ", ".join(
        f"CAST(sum({c}) OVER w AS BIGINT) AS {c}, round(CASE WHEN row_number() OVER o >= 7 THEN stddev_samp({c}) OVER w END, 6) AS {c}_std"
        for c in ("Code_160", "Code_177")
    )
    windows = """WINDOW o AS (PARTITION BY customer_asset_identifier ORDER BY date),
           w AS (PARTITION BY customer_asset_identifier ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
    groups = [f"CodeType_1_criticality_{c}" for c in (1, 2, 3)]
    own = ", ".join(f"{name}, round({name}_std, 6) AS {name}_std" for name in groups)
    listed = "160, 177, 12, 74, 64, 182, 307, 306, 310, 305, 312"
    requests = ", ".join(
        f"CAST({name} AS VARCHAR) AS {name}" if name == "service_request_date" else name
        for name in ("customer_asset_identifier", "service_request_date", "incident_category", "incident_status", "customer_id", '"Asset_serial_number"', '"Priority"')
    )
    return {
        "facts_other_windows": with_ctes(
            f"""SELECT a.*, CASE WHEN ahead <= 10 THEN 1 ELSE 0 END AS failure_event,
                  CASE WHEN ahead < 90 THEN ahead ELSE 90 END AS day_to_failure, c.* EXCLUDE (customer_asset_identifier, date)
                FROM (SELECT {KEY}, CAST(sum(working_unit) OVER w AS BIGINT) AS notes_in_last30,
                        CAST(sum(working_unit) OVER w AS DOUBLE) / 7 AS Avg_notes_in_last30 FROM worked {windows}) a
                JOIN failure_ahead f USING ({KEY}) JOIN (SELECT {KEY}, {weekly} FROM code_filled {windows}) c USING ({KEY})""",
            "worked",
            "failure_ahead",
            "code_filled",
        ),
        "codes_without_listed": with_ctes(f"SELECT {KEY}, {own} FROM code_rolling_unlisted", "code_rolling_unlisted").replace(
            "code_type = 1 AND", f"code_type = 1 AND code_id NOT IN ({listed}) AND"
        ),
        "devices_from_master": with_ctes(
            f"""SELECT {KEY}, date - installed_date AS age, n_name AS model_name, 100 * (n_nationkey + 1) AS capacity
                FROM spine JOIN nation ON n_nationkey = product_identifier""",
            "spine",
        ),
        "facts_without_devices": with_ctes(f"SELECT {KEY}, notes_in, notes_in_last30, age FROM work_sums", "work_sums"),
        "sink_service_requests": f"SELECT {requests} FROM ({reference['service_request_history']}) WHERE incident_category IS NOT NULL",
        "sink_error_codes": f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM ({reference['asset_error_codes']})",
        "periodic_work_own_master": reference["periodic_work_inner"].replace("JOIN assets a", "JOIN s_assets a").replace(*_assets_for("s_assets")),
        "technician_history_own_master": reference["technician_history_inner"].replace("JOIN assets a", "JOIN s_assets a").replace(*_assets_for("s_assets")),
    }


def _assets_for(name: str) -> tuple[str, str]:
    return f"assets AS ({_CTES['assets'][1]})", f"{name} AS ({_CTES[name][1]})"


# ---- screening of the fact bridge's assets: the rules above, on its tables and limits ----

_FLEET = ["universe", "inactive", "daily", "manual", "manual_only", "steps", "runs", "irregular", "few", "future", "errors", "valid"]


def _fleet_ctes() -> None:
    for name in _FLEET:
        needs, text = _CTES[f"s_{name}"]
        for old, new in {"s_": "f_", "max(run) > 6": "max(run) > 45", "count(*) <= 60": "count(*) <= 185", SCREEN_AS_OF: AS_OF}.items():
            text = text.replace(f" {old}", f" {new}") if old == "s_" else text.replace(old, new)
        _CTES[f"f_{name}"] = ([f"f_{need[2:]}" for need in needs], text)


_CTES.update(
    {
        "f_assets": (["assets"], "SELECT * FROM assets"),
        "f_work": (["work_rows"], "SELECT customer_asset_identifier, date, row_number() OVER () AS event_id FROM work_rows"),
        "f_life": (
            ["assets"],
            """SELECT l_suppkey AS customer_asset_identifier, CAST(l_shipdate AS DATE) AS date, 3 AS life_event_code,
                  CASE WHEN l_suppkey % 7 = 3 THEN 2 WHEN l_suppkey % 7 IN (1, 5) AND l_partkey % 4 = 0 THEN 2 ELSE 1 END AS life_event_value
               FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 7
               UNION ALL
               SELECT l_suppkey, CAST(l_shipdate AS DATE), 2, CASE WHEN l_suppkey % 10 = 4 AND l_partkey % 3 = 0 THEN 0 ELSE 1 END
               FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 6
               UNION ALL
               SELECT l_suppkey, CAST(l_shipdate AS DATE), 4, l_partkey % 50
               FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 5 AND l_quantity > 40
               UNION ALL
               SELECT customer_asset_identifier, installed_date, 3, CASE WHEN customer_asset_identifier % 7 = 3 THEN 2 ELSE 1 END
               FROM assets WHERE customer_asset_identifier % 4 <> 2""",
        ),
        "f_log_days": (
            ["f_life"],
            f"""SELECT customer_asset_identifier, date, bool_and(life_event_value IS NOT DISTINCT FROM 1) AS ok
                FROM f_life WHERE life_event_code = 3 AND date <= {AS_OF} GROUP BY 1, 2""",
        ),
        "f_first_work": (
            ["work_rows"],
            f"SELECT customer_asset_identifier, min(date) AS first_day FROM work_rows WHERE date <= {AS_OF} GROUP BY 1",
        ),
        "f_other_days": (
            ["f_first_work", "f_log_days"],
            f"""SELECT d.customer_asset_identifier FROM (
                  SELECT customer_asset_identifier, CAST(unnest(generate_series(first_day, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date
                  FROM f_first_work) d
                ASOF LEFT JOIN f_log_days l ON l.customer_asset_identifier = d.customer_asset_identifier AND l.date <= d.date
                WHERE l.ok IS DISTINCT FROM true""",
        ),
        "f_firmware_events": (
            ["f_life"],
            f"""SELECT customer_asset_identifier, date AS day, max(life_event_value) AS version
                FROM f_life WHERE life_event_code = 4 AND date <= {AS_OF} GROUP BY 1, 2""",
        ),
    }
)
_fleet_ctes()


def _firmware_sql(first: str, second: str | None) -> str:
    rest = f"UNION ALL SELECT * FROM {second} b WHERE NOT EXISTS (SELECT 1 FROM {first} a WHERE a.customer_asset_identifier = b.customer_asset_identifier AND a.day = b.day)"
    both = f"(SELECT * FROM {first} {rest if second else ''})"
    daily = _CTES["firmware_daily"][1].replace("JOIN firmware f", f"JOIN {both} f")
    return with_ctes(f"SELECT customer_asset_identifier, date, CAST(firmwareHistory AS INTEGER) AS firmwareHistory FROM ({daily})", "spine", "firmware", "f_firmware_events")


def fleet_sql() -> dict[str, str]:
    valid = "customer_asset_identifier IN (SELECT customer_asset_identifier FROM f_valid)"
    causes = {
        "f_inactive": "not active",
        "f_manual_only": "log status manual",
        "f_irregular": "irregular work",
        "f_few": "too few work rows",
        "f_future": "install date in the future",
    }
    cases = " ".join(f"WHEN x.id IN (SELECT customer_asset_identifier FROM {table}) THEN '{cause}'" for table, cause in causes.items())
    needed = [*_FACT_PARTS, "features", "f_valid"]
    return {
        "daily_facts_valid": with_ctes(f"{_FACT_SELECT} WHERE {valid}", *needed),
        "ml_prepared_valid": with_ctes(f"{_prepared_select()} AND {valid}", *needed),
        "dropped_assets": with_ctes(
            f"""SELECT id AS customer_asset_identifier, cause FROM (
                  SELECT x.id, CASE {cases}
                    WHEN x.id NOT IN (SELECT customer_asset_identifier FROM daily_work) THEN 'no work'
                    WHEN x.id NOT IN (SELECT customer_asset_identifier FROM assets) THEN 'not in master'
                    WHEN x.id NOT IN (SELECT customer_asset_identifier FROM assets JOIN features USING (product_identifier)) THEN 'no device row'
                  END AS cause
                  FROM (SELECT customer_asset_identifier AS id FROM assets UNION SELECT customer_asset_identifier FROM work_rows) x)
                WHERE cause IS NOT NULL""",
            *causes,
            "daily_work",
            "assets",
            "features",
        ),
        "log_status_throughout": with_ctes(
            f"""SELECT w.customer_asset_identifier, first_day, {AS_OF} AS last_day,
                  CAST(NOT EXISTS (SELECT 1 FROM f_other_days o WHERE o.customer_asset_identifier = w.customer_asset_identifier) AS INTEGER) AS log_throughout
                FROM f_first_work w""",
            "f_first_work",
            "f_other_days",
        ),
        "eligible_assets": with_ctes(
            f"""SELECT DISTINCT customer_asset_identifier AS id FROM assets
                WHERE installed_date > DATE '1996-12-31' AND installed_date + 400 < {AS_OF}
                  AND customer_asset_identifier IN (SELECT customer_asset_identifier FROM work_rows WHERE date <= {AS_OF}
                                                    GROUP BY 1 HAVING count(DISTINCT date) >= 180)
                  AND customer_asset_identifier IN (SELECT customer_asset_identifier FROM f_first_work)
                  AND customer_asset_identifier NOT IN (SELECT customer_asset_identifier FROM f_other_days)""",
            "assets",
            "work_rows",
            "f_first_work",
            "f_other_days",
        ),
        "firmware_from_life_events": _firmware_sql("f_firmware_events", None),
        "firmware_history_first": _firmware_sql("firmware", "f_firmware_events"),
        "firmware_life_events_first": _firmware_sql("f_firmware_events", "firmware"),
        "forest_report": with_ctes(
            f"""SELECT date, customer_asset_identifier, failure_event, notes_in_last_pm, 1 AS is_probability
                FROM report WHERE date = {TEST_END}""",
            "report",
        ),
        "forest_metrics": with_ctes(
            """SELECT count(*) FILTER (WHERE failure_event = 0) AS negatives, count(*) FILTER (WHERE failure_event = 1) AS positives,
                 1 AS are_shares FROM report""",
            "report",
        ),
        "class_weights": with_ctes(
            f"""SELECT c.class, count(l.date) AS rows,
                  round((SELECT count(*) FROM labels_daily WHERE date BETWEEN DATE '1998-01-01' AND {TRAIN_END}) / (2.0::DOUBLE * greatest(count(l.date), 1)), 6) AS weight
                FROM (SELECT unnest([0, 1]) AS class) c LEFT JOIN labels_daily l
                  ON l.failure_event = c.class AND l.date BETWEEN DATE '1998-01-01' AND {TRAIN_END}
                GROUP BY c.class""",
            "labels_daily",
        ),
    }


def all_sql() -> dict[str, str]:
    return {**facts_sql(), **option_sql(), **filter_sql(), **variant_sql(), **fleet_sql(), **screening_sql(), **reference_sql(), **model_sql()}
