"""Spans, chains and stored models on small hand-made fleets."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from fleet import FAIL, PM, d, frame, sources
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assetpulse import schemas
from assetpulse.constants import ASSET
from assetpulse.functions import days_in_mask, packed_order
from assetpulse.operators import coverage, filters, model
from assetpulse.plans import fleet, screening
from assetpulse.plans.daily_facts import FactSettings, daily_change, daily_facts, operational_age, row_change, timeline
from assetpulse.sources import valid_dates

ONE = dt.timedelta(1)


def random_fleet(spark, seed, assets=5):
    rng = random.Random(seed)

    def some_day():
        return d("2020-01-01") + ONE * rng.randrange(-20, 160)

    master = [(a, d("2020-01-01") + ONE * rng.randrange(-30, 40), "Active", 7) for a in range(1, assets + 1)]
    work = [(a, some_day(), rng.choice([None, 0, 3, 8]), i) for a, *_ in master for i in range(rng.choice([1, 20, 60]))]
    requests = [(a, some_day(), rng.choice([PM, FAIL, None])) for a, *_ in master for _ in range(6)]
    errors = [(a, some_day(), rng.choice([5, 6]), 1, 1) for a, *_ in master for _ in range(40)]
    return sources(spark, master, work, requests, errors)


def key(row):
    return row[ASSET], row["date"]


@pytest.mark.parametrize("first_date", [None, "2020-02-10"])
def test_change_equals_a_dense_window(spark, first_date):
    """Also over columns that are neither constant nor linear between change days."""
    settings = FactSettings(window_days=7, horizon_days=5, cap_days=20, codes=(5, 6), code_types=(), criticalities=(), device_columns=None)
    columns = ["age", "last_pm_date", "notes_in", "notes_in_last30", "notes_in_last_pm", "day_to_failure", "Avg_notes_in", "Code_5", "Code_5_std", "Code_6_std", "failure_event"]
    inputs = random_fleet(spark, 3)
    dense = row_change(daily_facts(inputs, "2020-06-30", settings), columns)
    got = daily_change(inputs, "2020-06-30", replace(settings, first_date=first_date), columns)
    want = {key(r): (r["distance"], r["changed"]) for r in dense.collect() if first_date is None or r["date"] >= d(first_date)}
    rows = got.collect()
    assert len(rows) == len(want) > 100
    for row in rows:
        distance, changed = want[key(row)]
        assert row["changed"] == changed and (row["distance"] == pytest.approx(distance) if distance is not None else row["distance"] is None)


def test_weekday_masks(spark):
    rows = [(m, n) for m in (0, 1, 5, 64, 127) for n in range(0, 30)]
    df = spark.createDataFrame(rows, "m int, n int").select("m", "n", days_in_mask(F.col("m"), F.col("n")).alias("days"))
    for row in df.collect():
        assert row["days"] == sum(row["m"] >> (i % 7) & 1 for i in range(row["n"]))


def test_operational_age_equals_the_dense_join(spark):
    inputs = random_fleet(spark, 5)
    hours = spark.createDataFrame([(1, 0, 8.0), (1, 3, 0.0), (1, 4, None), (2, 6, 8.0), (2, 1, 1.0), (3, 1, 1.0), (3, 2, -1.0), (9, 1, 8.0)], schemas.OPERATIONAL_DAYS)
    plain = FactSettings(device_columns=None, code_types=(), codes=())
    dense = operational_age(daily_facts(inputs, "2020-04-30", plain).select(ASSET, "date"), inputs.assets, hours)
    want = {key(r): r["operational_age"] for r in dense.collect()}
    got = daily_facts(replace(inputs, operational_days=hours), "2020-04-30", plain)
    assert {key(r): r["operational_age"] for r in got.collect()} == want and len(set(want.values())) > 10
    fewer = daily_facts(replace(inputs, operational_days=hours), "2020-04-30", replace(plain, min_hours=2))
    assert {key(r): r["operational_age"] for r in fewer.collect()} != want


def test_packed_order(spark):
    rng = random.Random(2)
    values = [None, 0, 1, 2**34 - 2]
    rows = [(i, rng.choice(values), rng.choice([None, 0, 5, 2**12 - 2]), rng.choice(values), rng.choice([None, 0, 2**40 - 2])) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, a long, b int, c long, e long")
    for bits in ([("b", 12)], [("a", 34), ("b", 12)], [("e", 40), ("a", 34), ("b", 12), ("c", 35)]):
        packed = packed_order([(F.col(name), n) for name, n in bits])
        rows = df.select(packed.alias("k"), *[name for name, _ in bits]).collect()
        tuples = [tuple(-1 if row[name] is None else row[name] for name, _ in bits) for row in rows]
        order = {t: n for n, t in enumerate(sorted(set(tuples)))}
        ranks = {k: n for n, k in enumerate(sorted({row["k"] for row in rows}))}
        assert [ranks[row["k"]] for row in rows] == [order[t] for t in tuples]
    with pytest.raises(PySparkException):  # a value that does not fit is an error
        df.select(packed_order([(F.col("a"), 20)])).collect()
    with pytest.raises(ValueError):
        packed_order([(F.col("a"), 62), (F.col("b"), 62), (F.col("c"), 10)])


LIFE = "customer_asset_identifier long, date date, life_event_code int, life_event_value int"


def test_log_status_throughout(spark):
    work = spark.createDataFrame([(a, d("2020-03-01")) for a in range(1, 9)] + [(1, d("2020-05-01")), (10, d("2021-03-01"))], "customer_asset_identifier long, date date")
    events = [
        (1, "2020-01-01", 3, 1), (1, "2020-06-01", 3, 1),  # always daily
        (2, "2020-03-02", 3, 1),  # unknown on the first work day
        (3, "2020-01-01", 3, 2), (3, "2020-03-01", 3, 1),  # manual ended in time
        (4, "2020-01-01", 3, 1), (4, "2020-04-01", 3, 2), (4, "2020-04-02", 3, 1),  # one bad day
        (5, "2020-01-01", 3, 1), (5, "2020-07-01", 3, 2),  # changed after as_of
        (6, "2020-01-01", 3, 1), (6, "2020-04-01", 3, 1), (6, "2020-04-01", 3, 2),  # two values on a day
        (7, "2020-01-01", 3, 1), (7, "2020-04-01", 2, 0), (7, None, 3, 2), (7, "2020-06-30", 3, None),  # null value on the last day
        (9, "2020-01-01", 3, 1),  # no work
    ]
    life = spark.createDataFrame([(a, day and d(day), code, value) for a, day, code, value in events], LIFE)
    got = {r[ASSET]: r["log_throughout"] for r in coverage.log_status_throughout(life, work, "2020-06-30").collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1, 6: 0, 7: 0, 8: 0}

    assets = spark.createDataFrame(
        [(1, d("2019-12-01")), (1, d("2019-12-01")), (3, d("2009-01-01")), (5, d("2020-05-01")), (8, d("2019-12-01"))],
        "customer_asset_identifier long, installed_date date",
    )

    def ids(**options):
        return sorted(r["id"] for r in coverage.eligible_assets(assets, work, life, "2020-06-30", **options).collect())

    assert ids(min_days=1) == [1]
    assert ids(min_days=2, after=None) == [1]
    assert ids(min_days=1, after=None) == [1, 3]
    assert ids(min_days=None, min_age_days=None) == [1, 5]
    assert ids(min_days=None, min_age_days=None, log_status=None, after=None) == [1, 3, 5, 8]


@pytest.mark.parametrize("source", ["history", "life_events", "history_first", "life_events_first"])
def test_firmware_from_two_sources(spark, source):
    inputs = sources(spark, [(1, d("2020-01-01"), "Active", 7)], [(1, d("2020-01-01"), 1)], firmware=[(1, 1, "2020-01-02 10:00:00"), (1, 2, "2020-01-05 10:00:00"), (1, 3, "2020-01-05 10:00:01")])
    life = spark.createDataFrame([(1, d("2020-01-03"), 4, 11), (1, d("2020-01-05"), 4, 12), (1, d("2020-01-05"), 4, 13), (1, d("2020-01-06"), 3, 99)], LIFE)
    events = valid_dates(filters.firmware_from_life_events(life, "life_event_code", "life_event_value"), "created_date")
    settings = FactSettings(device_columns=None, firmware_source=source)
    rows = daily_facts(replace(inputs, firmware_events=events), "2020-01-07", settings).orderBy("date").collect()
    want = {"history": [1, 1, 1, 1, 3, 3, 3], "life_events": [11, 11, 11, 11, 13, 13, 13]}
    want |= {"history_first": [1, 1, 11, 11, 3, 3, 3], "life_events_first": [1, 1, 11, 11, 13, 13, 13]}
    assert [row["firmwareHistory"] for row in rows] == want[source]


def test_chain_and_ledger(spark):
    """Each rule drops an asset; assets that pass all rules may still lack what a fact needs."""
    days = [d("2020-01-01") + ONE * i for i in range(70)]
    names = {1: None, 2: "not active", 3: "log status manual", 4: "irregular work", 5: "too few work rows", 6: "install date in the future",
             7: "no work", 8: "not in master", 9: "no device row", 10: "no work", 11: "not active", 12: "no install date"}
    master = [(a, d("2019-12-01"), "Active", 7) for a in (1, 2, 3, 4, 5, 7, 10, 11)]
    master += [(6, d("2021-01-01"), "Active", 7), (9, d("2019-12-01"), "Active", 8), (12, None, "Active", 7)]
    work = [(a, day, 1) for a in (1, 2, 3, 6, 8, 9, 12) for day in days] + [(4, days[0] + 3 * ONE * i, 1) for i in range(70)]
    work += [(a, day, 1) for a in (5, 11) for day in days[:5]] + [(10, d("2021-02-01") + ONE * i, 1) for i in range(70)]
    life = [(2, d("2020-01-01"), 2, 0), (3, d("2020-01-01"), 3, 2), (11, d("2020-01-01"), 2, 0), (1, d("2020-01-01"), 3, 1)]
    inputs = sources(spark, master, work, features=[(7, "A", 1)])
    run = fleet.screen_fleet(inputs, spark.createDataFrame(life, LIFE), "2020-12-31", screening.ScreenSettings())
    assert {r[ASSET]: r["cause"] for r in run.dropped().collect()} == {a: cause for a, cause in names.items() if cause}
    assert {r[ASSET] for r in run.facts().select(ASSET).distinct().collect()} == {1}
    assert {r["id"] for r in run.valid().collect()} == {1, 8, 9, 10, 12}


def test_prepared_facts_equal_prepare(spark):
    inputs = random_fleet(spark, 8)
    features = frame(spark, schemas.ASSET_FEATURES, [(7, "B", 1), (7, "A", 2)]).withColumn("security_type", F.lit("S"))
    inputs = replace(inputs, asset_features=features)
    security = spark.createDataFrame([("T", 4)], "security_type string, id int")
    models = spark.createDataFrame([("A", 8), ("A", 9), ("B", 1)], "model_name string, id int")
    settings = FactSettings(codes=(5,), code_types=(), criticalities=())
    want = model.prepare(daily_facts(inputs, "2020-06-30", settings), security, models, "2020-05-31", "2020-02-01")
    got = fleet.prepared_facts(inputs, security, models, "2020-06-30", "2020-05-31", "2020-02-01", settings)
    assert got.columns == want.columns and got.first()["model_name"] == 9 and got.first()["security_type"] == 0
    assert got.count() > 50 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stored_model(spark, tmp_path):
    rng = random.Random(4)
    rows = [(a, d("2020-01-01") + ONE * n, rng.randrange(50), rng.random(), int(rng.random() < 0.3)) for a in range(20) for n in range(60)]
    data = spark.createDataFrame(rows, "customer_asset_identifier long, date date, notes_in_last_pm int, x double, failure_event int")
    plain = model.run_model(data, "2020-02-10", trees=5)
    stored = model.run_model(data, "2020-02-10", trees=5, store=str(tmp_path / "forest"), version="7", trained_on="2020-02-11")
    assert plain.predictions.exceptAll(stored.predictions).count() == 0 and stored.predictions.count() == plain.predictions.count()
    again = model.read_model(str(tmp_path / "forest"))
    assert (again.version, again.train_end, again.trained_on, again.features) == ("7", "2020-02-10", "2020-02-11", ("notes_in_last_pm", "x"))
    test = model.time_split(data, "2020-02-10")[1]
    assert again.predict(test).exceptAll(stored.predictions).count() == 0
    for bad, text in ((test.drop("x"), "missing"), (test.withColumn("x", F.lit("a")), "not numeric"), (test.withColumn("y", F.lit(1)), "unknown")):
        with pytest.raises(ValueError, match=text):
            again.predict(bad)
    weights = {r["class"]: (r["rows"], r["weight"]) for r in model.class_weights(data.limit(0)).collect()}
    assert weights == {0: (0, 0.0), 1: (0, 0.0)}


def test_timeline_of_empty_sources(spark):
    inputs = sources(spark, [(1, d("2020-01-01"), "Active", 7)], [(1, d("2020-01-02"), 1)], requests=[], errors=[])
    empty = replace(inputs, work=inputs.work.limit(0))
    assert timeline(empty, "2020-02-01", FactSettings(device_columns=None)).states.count() == 0
    assert daily_change(empty, "2020-02-01", FactSettings(device_columns=None), ["age"]).count() == 0
