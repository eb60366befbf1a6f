"""Small hand-made fleets and a day-by-day evaluation of the fact columns in plain Python."""

from __future__ import annotations

import datetime as dt
import statistics

from assetpulse import schemas
from assetpulse.constants import NON_FAILURE_CATEGORIES, PM_CATEGORY
from assetpulse.plans.daily_facts import FactSources
from assetpulse.sources import valid_dates

PM, FAIL = PM_CATEGORY, "Hardware Fault"


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def frame(spark, schema, rows):
    return spark.createDataFrame([row + (None,) * (len(schema) - len(row)) for row in rows], schema)


def sources(spark, assets, work, requests=None, errors=None, firmware=None, features=None, valid=None) -> FactSources:
    """Rows are given by leading columns of the schemas; work rows end with a sequence number as tie-break."""
    work_schema = "customer_asset_identifier long, date date, working_unit long, seq int"
    request_rows = None if requests is None else [(a, day, kind) for a, day, kind in requests]
    error_rows = (
        None
        if errors is None
        else [(a, "SN", 1, day, "00:00", code, kind, level, "text") for a, day, code, kind, level in errors]
    )
    return FactSources(
        work=spark.createDataFrame([row if len(row) == 4 else (*row, 0) for row in work], work_schema),
        assets=frame(spark, schemas.ASSETS, assets),
        work_tie_break=["seq"],
        valid=None if valid is None else frame(spark, schemas.VALID_ASSETS, [(a,) for a in valid]),
        service_requests=None if requests is None else frame(spark, schemas.SERVICE_REQUESTS, request_rows),
        error_events=None if errors is None else frame(spark, schemas.ERROR_EVENTS, error_rows),
        firmware=None
        if firmware is None
        else valid_dates(frame(spark, schemas.FIRMWARE_HISTORY, firmware), "created_date"),
        asset_features=None if features is None else frame(spark, schemas.ASSET_FEATURES, features),
    )


def rows_by_day(df, asset=1):
    return {row["date"]: row for row in df.collect() if row["customer_asset_identifier"] == asset}


def expected_facts(asset, work, requests, errors, firmware, as_of, codes, window=30, horizon=30, cap=180):
    """Every fact column of one asset, one day at a time, straight from the definitions."""
    install = asset[1]
    last_of_day = {}
    for row in work:
        if row[1] <= as_of:
            key = (row[3] if len(row) == 4 else 0,)
            if row[1] not in last_of_day or key >= last_of_day[row[1]][0]:
                last_of_day[row[1]] = (key, row[2] or 0)
    if not last_of_day:
        return {}
    start = max(min(last_of_day), install)
    one = dt.timedelta(1)
    days = [start + one * i for i in range((as_of - start).days + 1)]
    pms = sorted(r[1] for r in requests if r[2] == PM and install <= r[1] <= as_of)
    fails = sorted(
        r[1] for r in requests if r[2] and r[2] not in NON_FAILURE_CATEGORIES and install <= r[1] <= as_of
    )
    versions = sorted((text, v) for _, v, text in firmware if text and "0000" not in text)
    by_day = {}
    for text, version in versions:
        if d(text[:10]) <= as_of:
            by_day[d(text[:10])] = version
    out = {}
    for t in days:
        units = [last_of_day[u][1] if u in last_of_day else 0 for u in days if u <= t]
        past_pm = [p for p in pms if p <= t]
        opened = max([p for p in past_pm if p >= start], default=start)
        past_fail = [f for f in fails if f <= t]
        ahead = min([(f - t).days for f in fails if f >= t], default=None)
        known = [by_day[u] for u in sorted(by_day) if u <= t]
        later = [by_day[u] for u in sorted(by_day) if u > t and by_day[u] is not None]
        fw = known[-1] if known and known[-1] is not None else (later[0] if later else None)
        row = {
            "notes_in": sum(units),
            "notes_in_last30": sum(units[-window:]),
            "notes_in_last_pm": sum(last_of_day[u][1] for u in last_of_day if opened <= u <= t),
            "last_pm_date": (t - max(past_pm, default=install)).days,
            "firmwareHistory": fw,
            "failure_event": int(ahead is not None and ahead <= horizon),
            "day_to_failure": cap if ahead is None else min(cap, ahead),
            "numIncidents": len(past_fail),
            "days_Since_failure": (t - max(past_fail, default=install)).days,
            "age": (t - install).days,
        }
        for code in codes:
            counts = [sum(1 for e in errors if e[1] == u and e[2] == code) for u in days if u <= t]
            row[f"Code_{code}"] = sum(counts[-window:])
            row[f"Code_{code}_std"] = statistics.stdev(counts[-window:]) if len(counts) >= window else None
        out[t] = row
    return out
