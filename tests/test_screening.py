import datetime as dt
import random

from fleet import d

from assetpulse import schemas
from assetpulse.constants import REASONS
from assetpulse.plans import screening

ONE = dt.timedelta(1)


def ids(df):
    return sorted(row[0] for row in df.collect())


def work_table(spark, days_by_asset):
    rows = [(a, day, 1) for a, days in days_by_asset.items() for day in days]
    return spark.createDataFrame(rows, schemas.DAILY_WORK)


def every_day(n, first="2020-01-01"):
    return [d(first) + ONE * i for i in range(n)]


def longest_run(days):
    best = run = 0
    days = sorted(days)
    for a, b in zip(days, days[1:]):
        run = 0 if b == a + ONE else run + 1
        best = max(best, run)
    return best


def test_irregular_runs(spark):
    def spaced(steps):
        return [d("2020-01-01") + ONE * 2 * i for i in range(steps + 1)]

    days = {
        1: spaced(15),
        2: spaced(16),
        3: every_day(40) + every_day(40, "2020-05-19"),  # one hole of 100 days: one step
        4: [d("2020-01-01")],
        5: [d("2020-01-01")] * 17,  # repeated dates are irregular
        6: [d("2020-01-01")] * 9 + [d("2020-01-02")] * 9,
    }
    profile = {row[0]: row for row in screening.work_profile(work_table(spark, days)).collect()}
    assert {a: row["longest_irregular_run"] for a, row in profile.items()} == {1: 15, 2: 16, 3: 1, 4: 0, 5: 16, 6: 8}
    assert profile[3]["longest_gap"] == 100 and profile[4]["longest_gap"] is None
    rng = random.Random(3)
    days = {a: [d("2020-01-01") + ONE * rng.randrange(40) for _ in range(rng.randrange(1, 60))] for a in range(20)}
    got = {row[0]: row["longest_irregular_run"] for row in screening.work_profile(work_table(spark, days)).collect()}
    assert got == {a: longest_run(list_) for a, list_ in days.items()}


def fleet(spark):
    """1 fine; 2 inactive once; 3 manual only; 4 irregular; 5 sixty rows; 6 future install; 7 no work, future; 8 daily and manual."""
    days = {a: every_day(61) for a in (1, 2, 3, 6, 8)}
    days[4] = every_day(61) + [d("2020-06-01") + ONE * 2 * i for i in range(17)]
    days[5] = every_day(60)
    as_of = d("2020-12-31")
    assets = [(a, d("2019-01-01"), "Active") for a in (1, 2, 3, 4, 5)]
    assets += [(6, as_of + ONE, "Active"), (7, as_of + ONE, None), (8, as_of, "Inactive"), (9, d("2019-01-01"), "Active")]
    day = d("2020-01-01")
    life = [(a, day, 3, 1) for a in (1, 2, 8)] + [(3, day, 3, 2), (8, day, 3, 2), (9, day, 3, 2)]
    life += [(2, day, 2, 1), (2, day, 2, 0), (1, day, 2, 1), (9, day, 2, 0)]
    frame = spark.createDataFrame([r + (None,) * 3 for r in assets], schemas.ASSETS)
    return frame, work_table(spark, days), spark.createDataFrame([r + (None,) for r in life], schemas.LIFE_EVENTS), as_of


def test_rules_and_lists(spark):
    assets, work, life, as_of = fleet(spark)
    result = screening.screen_assets(assets, work, life, as_of)
    errors = sorted((row[0], row[1]) for row in result.error_log.collect())
    assert errors == [(2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 5)]
    assert set(reason for _, reason in errors) == set(REASONS)
    assert ids(result.valid_ids()) == [1, 8]
    assert ids(result.error_ids()) == [2, 3, 4, 5, 6]  # 7 has no work, so it is outside the universe
    assert ids(result.category("daily_only")) == [1, 2] and ids(result.category("daily_and_manual")) == [8]
    assert ids(result.category("active")) == [1, 2] and ids(result.category("inactive")) == [2]
    assert ids(result.category("long_gap")) == [4]
    summary = {row["metric"]: row["value"] for row in result.summary.collect()}
    assert summary["passing all filters"] == 2 and summary["in error log"] == 5 and summary["future install"] == 2


def test_master_variant(spark):
    assets, work, life, as_of = fleet(spark)
    result = screening.screen_assets(assets, work, life, as_of, screening.ScreenSettings(variant="master"))
    errors = sorted((row[0], row[1]) for row in result.error_log.collect())
    assert errors == [(3, 2), (4, 3), (5, 4), (6, 5), (8, 1)]
    assert ids(result.valid) == [1, 2, 7, 9]


def test_null_status_value_and_empty_categories(spark):
    work = work_table(spark, {1: every_day(61)})
    assets = spark.createDataFrame([(1, d("2019-01-01"), None, None, None, None)], schemas.ASSETS)
    life = spark.createDataFrame([(1, d("2020-01-01"), 2, None, None)], schemas.LIFE_EVENTS)
    result = screening.screen_assets(assets, work, life, "2020-12-31")
    assert [tuple(row) for row in result.error_log.collect()] == [(1, 1)]
    none = spark.createDataFrame([], schemas.LIFE_EVENTS)
    result = screening.screen_assets(assets, work, none, "2020-12-31")
    assert result.error_log.count() == 0 and ids(result.valid) == [1]


def test_matrix(spark):
    assets, work, life, as_of = fleet(spark)
    status = screening.asset_status(work, assets, life, as_of)
    rows = {row["product_id"]: row for row in screening.reason_matrix(assets, status).collect()}
    assert len(rows) == 10
    total = rows.pop(None)
    for name in screening.MATRIX_FLAGS:
        assert total[name] == sum(row[name] for row in rows.values())
    assert rows[9]["daily_notes_present"] == 0 and rows[9]["Active Asset"] == 1
    assert rows[7]["install_date_in_future"] == 1 and rows[7]["error_log"] == 0
    assert rows[8]["Log 1&2"] == 1 and rows[8]["inactive Asset"] == 1 and rows[3]["Log 2"] == 1


def test_spot_check(spark):
    assets, work, life, as_of = fleet(spark)
    result = screening.screen_assets(assets, work, life, as_of)
    pick, info, events, reasons = screening.spot_check(assets, life, result.error_log, seed=1)
    chosen = ids(pick)
    assert len(chosen) == 1 and ids(info) == chosen
    again = screening.spot_check(assets.repartition(3), life, result.error_log, seed=1)[0]
    assert ids(again) == chosen
    assert set(ids(events)) <= set(chosen) and set(ids(reasons)) <= set(chosen)
