import datetime as dt
import random

import pytest
from fleet import FAIL, PM, d, expected_facts, rows_by_day, sources
from pyspark.sql import functions as F

from assetpulse import schemas
from assetpulse.operators import filters
from assetpulse.plans.daily_facts import (
    FactSettings,
    daily_facts,
    daily_work_panel,
    dropped_assets,
    operational_age,
    row_change,
)

ASSET = (1, d("2020-01-01"), "Active", 7, "SN1", 1)
WORK = [(1, d("2020-01-10"), 5)]
PLAIN = FactSettings(codes=(5,), code_types=(), criticalities=(), device_columns=None)


def facts(spark, as_of="2020-12-31", asset=ASSET, work=WORK, settings=PLAIN, **inputs):
    return rows_by_day(daily_facts(sources(spark, [asset], work, **inputs), as_of, settings))


def test_label_edges(spark):
    got = facts(spark, requests=[(1, d("2020-09-01"), FAIL)])
    assert got[d("2020-08-02")]["failure_event"] == 1  # 30 days ahead
    assert got[d("2020-08-01")]["failure_event"] == 0  # 31 days ahead
    today = got[d("2020-09-01")]
    assert (today["failure_event"], today["day_to_failure"], today["days_Since_failure"]) == (1, 0, 0)
    assert got[d("2020-03-05")]["day_to_failure"] == 180
    assert got[d("2020-03-04")]["day_to_failure"] == 180  # 181 days ahead
    assert got[d("2020-03-06")]["day_to_failure"] == 179
    assert got[d("2020-09-02")]["day_to_failure"] == 180
    assert min(got) == d("2020-01-10") and max(got) == d("2020-12-31") and len(got) == 357


def test_incidents(spark):
    requests = [
        (1, d("2019-12-31"), FAIL),  # before install: ignored
        (1, d("2020-01-05"), FAIL),  # before start: counted from the first day
        (1, d("2020-02-01"), FAIL),
        (1, d("2020-02-01"), FAIL),
        (1, d("2020-02-02"), "Cleaning Supplies"),
        (1, d("2020-02-03"), None),
        (1, d("2021-01-01"), FAIL),  # after as_of
    ]
    got = facts(spark, requests=requests)
    assert got[d("2020-01-10")]["numIncidents"] == 1
    assert got[d("2020-01-10")]["days_Since_failure"] == 5
    assert got[d("2020-01-31")]["numIncidents"] == 1
    assert got[d("2020-02-01")]["numIncidents"] == 3
    assert got[d("2020-12-31")]["numIncidents"] == 3
    assert got[d("2020-12-31")]["day_to_failure"] == 180
    plain = facts(spark, requests=[])
    assert plain[d("2020-01-10")]["days_Since_failure"] == 9


def test_maintenance(spark):
    work = [(1, d("2020-01-10"), 5), (1, d("2020-01-12"), 7), (1, d("2020-01-20"), 11)]
    before = facts(spark, work=work, requests=[(1, d("2020-01-04"), PM), (1, d("2019-12-30"), PM)])
    assert before[d("2020-01-10")]["last_pm_date"] == 6
    assert before[d("2020-01-20")]["notes_in_last_pm"] == 23
    on_start = facts(spark, work=work, requests=[(1, d("2020-01-10"), PM)])
    assert on_start[d("2020-01-10")]["last_pm_date"] == 0
    assert on_start[d("2020-01-12")]["notes_in_last_pm"] == 12
    inside = facts(spark, work=work, requests=[(1, d("2020-01-12"), PM), (1, d("2020-01-12"), PM)])
    assert inside[d("2020-01-11")]["notes_in_last_pm"] == 5
    assert inside[d("2020-01-12")]["notes_in_last_pm"] == 7  # the maintenance day opens the new count
    assert inside[d("2020-01-20")]["notes_in_last_pm"] == 18
    assert inside[d("2020-01-11")]["last_pm_date"] == 10 and inside[d("2020-01-15")]["last_pm_date"] == 3
    scoped = facts(
        spark,
        work=work,
        requests=[(1, d("2020-01-04"), PM)],
        settings=FactSettings(pm_scope="from_start", device_columns=None),
    )
    assert scoped[d("2020-01-10")]["last_pm_date"] == 9


def test_firmware(spark):
    later = facts(spark, firmware=[(1, 3, "2020-03-01 08:00:00"), (1, 4, "2020-03-01 09:00:00")])
    assert later[d("2020-01-10")]["firmwareHistory"] == 4  # back-filled, last of the day
    rows = [
        (1, 1, "2019-06-01 00:00:00"),
        (1, 2, "2020-05-01 00:00:00"),
        (1, 9, "2021-05-01 00:00:00"),
        (1, 8, "0000-00-00 00:00:00"),
        (1, 8, None),
    ]
    got = facts(spark, firmware=rows)
    assert got[d("2020-01-10")]["firmwareHistory"] == 1
    assert got[d("2020-04-30")]["firmwareHistory"] == 1
    assert got[d("2020-12-31")]["firmwareHistory"] == 2
    none = facts(spark, firmware=[(1, 9, "2021-05-01 00:00:00")])
    assert none[d("2020-06-01")]["firmwareHistory"] is None


def test_work_columns(spark):
    work = [(1, d("2020-01-10"), 3, 1), (1, d("2020-01-10"), 8, 2), (1, d("2020-01-15"), None, 1), (1, d("2020-02-08"), 4, 1)]
    got = facts(spark, work=work)
    assert got[d("2020-01-10")]["notes_in"] == 8  # last row of the day
    assert got[d("2020-01-15")]["notes_in"] == 8  # a null unit adds nothing
    assert got[d("2020-02-08")]["notes_in_last30"] == 12  # day 30 of the window still holds the first
    assert got[d("2020-02-09")]["notes_in_last30"] == 4
    assert got[d("2020-02-09")]["notes_in"] == 12
    at_install = facts(spark, asset=(1, d("2020-01-10"), "Active", 7), work=work)
    assert at_install[d("2020-01-10")]["age"] == 0 and at_install[d("2020-01-10")]["Avg_notes_in"] is None
    assert at_install[d("2020-01-11")]["Avg_notes_in"] == 8.0
    late = facts(spark, asset=(1, d("2020-01-12"), "Active", 7), work=work)
    assert min(late) == d("2020-01-12") and late[d("2020-02-08")]["notes_in"] == 4  # work before install is dropped


def test_panel_and_date_range(spark):
    inputs = sources(spark, [ASSET], [(1, d("2020-01-10"), 5), (1, d("2020-01-13"), 2)])
    panel = rows_by_day(daily_work_panel(inputs, "2020-01-14"))
    assert [row["working_unit"] for _, row in sorted(panel.items())] == [5, 0, 0, 2, 0]
    cut = FactSettings(device_columns=None, first_date="2020-01-12", last_date="2020-01-13")
    part = rows_by_day(daily_facts(inputs, "2020-01-14", cut))
    assert sorted(part) == [d("2020-01-12"), d("2020-01-13")]
    assert part[d("2020-01-13")]["notes_in"] == 7


def test_code_window(spark):
    errors = [(1, d("2020-01-12"), 5, 1, 1)] * 3 + [(1, d("2020-01-05"), 5, 1, 1), (1, d("2020-01-12"), 6, 1, 2)]
    settings = FactSettings(codes=(5,), device_columns=None)
    got = facts(spark, errors=errors, settings=settings)
    assert got[d("2020-01-11")]["Code_5"] == 0  # the event before start does not count
    assert got[d("2020-02-10")]["Code_5"] == 3 and got[d("2020-02-11")]["Code_5"] == 0
    assert got[d("2020-02-07")]["Code_5_std"] is None  # 29 rows
    assert got[d("2020-02-08")]["Code_5_std"] == pytest.approx(0.547722557505166)
    assert got[d("2020-01-12")]["CodeType_1_criticality_1"] == 3
    assert got[d("2020-01-12")]["CodeType_1_criticality_2"] == 1
    without = FactSettings(codes=(5,), device_columns=None, exclude_listed_codes=True)
    got = facts(spark, errors=errors, settings=without)
    assert got[d("2020-01-12")]["CodeType_1_criticality_1"] == 0
    assert got[d("2020-01-12")]["Code_5"] == 3


def test_label_from_codes(spark):
    settings = FactSettings(failure_label="error_codes", failure_codes=(64,), device_columns=None)
    errors = [(1, d("2020-06-30"), 64, 1, 1), (1, d("2020-01-05"), 64, 1, 1), (1, d("2020-10-30"), 63, 1, 1)]
    got = facts(spark, errors=errors, requests=[(1, d("2020-03-01"), FAIL)], settings=settings)
    labelled = [day for day, row in got.items() if row["failure_event"]]
    assert min(labelled) == d("2020-05-31") and max(labelled) == d("2020-06-30") and len(labelled) == 31
    assert got[d("2020-03-01")]["day_to_failure"] == 0  # still from requests


def test_gates_and_devices(spark):
    assets = [
        (1, d("2020-01-01"), "Active", 7),
        (2, d("2020-01-01"), "Active", 8),
        (3, d("2020-01-01"), "Active", 7),
        (4, d("2021-01-01"), "Active", 7),
        (5, d("2020-01-01"), "Active", 7),
    ]
    work = [(a, d("2020-02-01"), 1) for a in (1, 2, 4, 5, 6)]
    features = [(7, "B", 1), (7, "A", 2)]
    inputs = sources(spark, assets, work, features=features, valid=[1, 2, 3, 4, 6, 1])
    df = daily_facts(inputs, "2020-02-03")
    assert {(row["customer_asset_identifier"], row["model_name"]) for row in df.collect()} == {(1, "A")}
    causes = {row["customer_asset_identifier"]: row["cause"] for row in dropped_assets(inputs, "2020-02-03").collect()}
    assert causes == {2: "no device row", 3: "no work", 4: "installed after as_of", 6: "not in master"}


def test_device_from_master(spark):
    inputs = sources(spark, [ASSET], WORK)
    inputs = type(inputs)(
        **{**inputs.__dict__, "assets": inputs.assets.withColumn("model_name", F.lit("M")).withColumn("capacity", F.lit(9))}
    )
    row = daily_facts(inputs, "2020-01-11", FactSettings(device_columns="master")).first()
    assert (row["model_name"], row["capacity"]) == ("M", 9)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_day_by_day_evaluation(spark, seed):
    rng = random.Random(seed)
    base, as_of = d("2020-01-01"), d("2020-06-30")

    def some_day():
        return base + dt.timedelta(rng.randrange(-40, 220))

    assets, work, requests, errors, firmware = [], [], [], [], []
    for a in range(1, 7):
        assets.append((a, base + dt.timedelta(rng.randrange(-30, 60)), "Active", 7))
        work += [(a, some_day(), rng.choice([None, 0, 1, 5, 9]), i) for i in range(rng.choice([2, 30, 120]))]
        requests += [(a, some_day(), rng.choice([PM, FAIL, "Welcome Call", None])) for _ in range(rng.randrange(12))]
        errors += [(a, some_day(), rng.choice([5, 6, 7]), 1, 1) for _ in range(rng.randrange(60))]
        firmware += [
            (a, rng.choice([1, 2, 3, None]), f"{some_day()} {rng.randrange(10, 24)}:{rng.randrange(10, 60)}:{i:02d}")
            for i in range(rng.randrange(5))
        ]
    settings = FactSettings(
        window_days=7, horizon_days=5, cap_days=20, codes=(5, 6), code_types=(), criticalities=(), device_columns=None
    )
    inputs = sources(spark, assets, work, requests, errors, firmware)
    rows = daily_facts(inputs, as_of, settings).collect()
    seen = 0
    for asset in assets:
        own = [[r for r in table if r[0] == asset[0]] for table in (work, requests, errors, firmware)]
        want = expected_facts(asset, *own, as_of, (5, 6), window=7, horizon=5, cap=20)
        got = {row["date"]: row for row in rows if row["customer_asset_identifier"] == asset[0]}
        assert set(got) == set(want)
        for date, expected in want.items():
            for name, value in expected.items():
                assert got[date][name] == pytest.approx(value), (asset[0], date, name)
                seen += 1
    assert seen > 500


def test_properties(spark):
    requests = [(1, d("2020-03-01"), FAIL), (1, d("2020-07-15"), FAIL), (1, d("2020-05-01"), PM)]
    got = [row for _, row in sorted(facts(spark, requests=requests).items())]
    assert all((row["day_to_failure"] <= 30) == (row["failure_event"] == 1) for row in got)
    assert all(b["numIncidents"] >= a["numIncidents"] and b["age"] == a["age"] + 1 for a, b in zip(got, got[1:]))


def test_operational_age(spark):
    inputs = sources(spark, [ASSET, (2, d("2020-01-01"), "Active", 7)], [*WORK, (2, d("2020-01-01"), 1)])
    panel = daily_work_panel(inputs, "2020-02-20")
    hours = spark.createDataFrame(
        [(1, 0, 8.0), (1, 3, 0.0), (1, 4, None), (1, 5, -1.0)], schemas.OPERATIONAL_DAYS
    )
    for row in operational_age(panel, inputs.assets, hours).collect():
        span = (row["date"] - d("2020-01-01")).days
        days = [d("2020-01-01") + dt.timedelta(i) for i in range(span + 1)]
        want = sum(1 for x in days if x.isoweekday() % 7 in (0, 3)) if row["customer_asset_identifier"] == 1 else 0
        assert row["operational_age"] == want


def test_row_change(spark):
    rows = [(1, d("2020-01-01"), 1.0, None), (1, d("2020-01-02"), 4.0, 4.0), (1, d("2020-01-03"), 4.0, 4.0), (2, d("2020-01-02"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "customer_asset_identifier long, date date, x double, y double")
    got = {(r[0], r[1]): (r["distance"], r["changed"]) for r in row_change(df, ["x", "y"]).collect()}
    assert got[(1, d("2020-01-01"))] == (None, None) and got[(2, d("2020-01-02"))] == (None, None)
    assert got[(1, d("2020-01-02"))] == (3.0, 1)  # a null coordinate counts as unchanged
    assert got[(1, d("2020-01-03"))] == (0.0, 0)


def test_filters(spark):
    assets = spark.createDataFrame(
        [(1, d("2009-05-01"), "Active"), (2, d("2019-11-01"), "Lost"), (3, d("2019-01-01"), None), (4, d("2019-01-01"), "Inactive")],
        "customer_asset_identifier long, installed_date date, active_status string",
    )

    def ids(df):
        return sorted(row[0] for row in df.collect())

    assert ids(filters.status_is(assets, "Active")) == [1]
    assert ids(filters.status_not(assets, "Active")) == [2, 3, 4]
    assert ids(filters.unknown_status(assets)) == [2]
    assert ids(filters.old_enough(assets, "2020-01-01")) == [1, 3, 4]
    assert ids(filters.installed_after(assets)) == [2, 3, 4]
    events = spark.createDataFrame(
        [(1, d("2020-01-01"), 3, 4, "x"), (1, d("2020-01-02"), 3, 1, "y")], schemas.LIFE_EVENTS
    )
    assert filters.life_events_where(events, 3, 1).count() == 1
    firmware = filters.firmware_from_life_events(events, "life_event_value", "life_event_code").collect()
    assert [(r[0], r[1], r[2]) for r in firmware] == [(1, 3, "2020-01-01")]
    requests = spark.createDataFrame(
        [(1, d("2020-01-01"), PM), (1, d("2020-02-01"), PM), (1, d("2020-01-01"), FAIL), (1, d("2020-01-01"), None)],
        "customer_asset_identifier long, service_request_date date, incident_category string",
    )
    assert filters.pm_requests(requests, "2020-01-01", "2020-01-31").count() == 1
    assert filters.failure_requests(requests, "2020-01-01", "2020-01-31").count() == 1
    last = filters.keep_last(requests.withColumn("n", F.lit(1)), ["customer_asset_identifier"], ["service_request_date"])
    assert last.first()["service_request_date"] == d("2020-02-01")
    assert filters.with_const(assets, customer_id=1).select("customer_id").distinct().count() == 1
