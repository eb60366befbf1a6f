import datetime as dt
import random

import pytest
from fleet import d
from pyspark.sql import functions as F

from assetpulse.operators import ranking

SCHEMA = "date date, customer_asset_identifier long, mdl_pred double, failure_event int, notes_in_last_pm long"


def report(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(seed, n=300, hot=0.35):
    """A third of the rows share one score."""
    rng = random.Random(seed)
    rows = []
    for date in (d("2020-01-01"), d("2020-01-02")):
        for a in range(n):
            score = 0.5 if rng.random() < hot else rng.randrange(60) / 60
            rows.append((date, a, score, int(rng.random() < 0.3), rng.randrange(40)))
    return rows


def expected_curves(rows, date):
    items = sorted([(r[2], r[3]) for r in rows if r[0] == date], reverse=True)
    hits = 0
    out = []
    for k, (_, label) in enumerate(items, 1):
        hits += label
        out.append((k, hits))
    return out, len(items), hits


@pytest.mark.parametrize("ranges", [1, 7, ranking.SCORE_RANGES])
def test_curves_against_sorted_lists(spark, ranges):
    """Results don't depend on the number of ranges."""
    rows = random_rows(5)
    groups = ranking.score_groups(report(spark, rows), "mdl_pred", "failure_event", ranges=ranges).cache()
    gain = {(r["date"], r["k"]): r for r in ranking.gain_curve(groups, chunk_rows=9).collect()}
    precision = {(r["date"], r["k"]): r for r in ranking.precision_curve(groups).collect()}
    areas = {r["date"]: r for r in ranking.curve_area(groups).collect()}
    aucs = {r["date"]: r["roc_auc"] for r in ranking.roc_auc(groups).collect()}
    assert len(gain) == len(rows) and len(precision) == 200
    for date in (d("2020-01-01"), d("2020-01-02")):
        want, n, hits = expected_curves(rows, date)
        for k, captured in want:
            assert gain[(date, k)]["x"] == pytest.approx((k - 1) / n)
            assert gain[(date, k)]["y"] == pytest.approx(captured / hits)
            if k <= 100:
                assert precision[(date, k)]["precision"] == pytest.approx(captured / k)
                assert precision[(date, k)]["base_rate"] == pytest.approx(hits / n)
        ys = [captured / hits for _, captured in want]
        area = sum((a + b) / 2 / n for a, b in zip(ys, ys[1:]))
        assert areas[date]["area"] == pytest.approx(area)
        assert areas[date]["area_over_random"] == pytest.approx(area - 0.5)
        pos = [r[2] for r in rows if r[0] == date and r[3]]
        neg = [r[2] for r in rows if r[0] == date and not r[3]]
        won = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
        assert aucs[date] == pytest.approx(won / len(pos) / len(neg))


def test_ties_put_failures_first(spark):
    rows = [(d("2020-01-01"), a, 0.5, int(a >= 2), 1) for a in range(4)]
    groups = ranking.score_groups(report(spark, rows), "mdl_pred", "failure_event")
    got = [r["precision"] for r in sorted(ranking.precision_curve(groups).collect(), key=lambda r: r["k"])]
    assert got == [1.0, 1.0, pytest.approx(2 / 3), 0.5]


@pytest.mark.parametrize("ranges", [1, 5, ranking.SCORE_RANGES])
def test_nan_and_null_scores_are_left_out(spark, ranges):
    rows = [(d("2020-01-01"), a, s, int(s > 0), 1) for a, s in enumerate([-2.5, -0.5, 0.0, 0.3, 7.0, 1e300, -1e300])]
    odd = [(d("2020-01-01"), 90, float("nan"), 1, 1), (d("2020-01-01"), 91, None, 1, 1)]
    infinite = [(d("2020-01-01"), 92, float("inf"), 1, 1), (d("2020-01-01"), 93, float("-inf"), 0, 1)]
    groups = ranking.score_groups(report(spark, rows + odd + infinite), "mdl_pred", "failure_event", ranges)
    assert [r["score"] for r in groups.orderBy("n_before").collect()] == sorted([r[2] for r in rows + infinite], reverse=True)
    assert ranking.roc_auc(groups).first()["roc_auc"] == 1.0


def test_no_failures_gives_null_not_error(spark):
    rows = [(d("2020-01-01"), a, a / 4, 0, 1) for a in range(4)]
    groups = ranking.score_groups(report(spark, rows), "mdl_pred", "failure_event")
    assert ranking.roc_auc(groups).first()["roc_auc"] is None
    assert ranking.curve_area(groups).first()["area"] is None
    assert ranking.gain_curve(groups).first()["y"] is None


def test_baseline_ranks(spark):
    rows = [(d("2020-01-01"), a, 0.1, 0, value) for a, value in enumerate([5, 5, 1, 9])]
    rows += [(d("2020-01-02"), a, 0.1, 0, value) for a, value in enumerate([3, 2])]
    got = {(r["date"], r["customer_asset_identifier"]): r["pctl_bl"] for r in ranking.baseline_score(report(spark, rows)).collect()}
    one, two = d("2020-01-01"), d("2020-01-02")
    assert got == {(one, 0): 2.5 / 4, (one, 1): 2.5 / 4, (one, 2): 0.25, (one, 3): 1.0, (two, 0): 0.5, (two, 1): 0.25}


def test_cutoffs(spark):
    rows = random_rows(8, n=120)
    df = report(spark, rows)
    groups = ranking.score_groups(df, "mdl_pred", "failure_event")
    cuts = {"red": 0.74, "orange": 0.5, "low": -1.0, "high": 2.0}
    got = {(r["date"], r["band"]): r for r in ranking.cutoff_points(groups, df, "mdl_pred", cuts).collect()}
    assert len(got) == 8
    for date in (d("2020-01-01"), d("2020-01-02")):
        want, n, hits = expected_curves(rows, date)
        scores = [r[2] for r in rows if r[0] == date]
        for band, cut in cuts.items():
            below, upto = sum(s < cut for s in scores), sum(s <= cut for s in scores)
            pct = (below + upto + (upto > below)) * 50 / n
            at = (n - 1) * (100 - pct) / 100
            low = int(at)
            high = min(low + 1, n - 1)
            ys = [captured / hits for _, captured in want]
            assert got[(date, band)]["percentile"] == pytest.approx(pct)
            assert got[(date, band)]["x"] == pytest.approx(at / n)
            assert got[(date, band)]["y"] == pytest.approx(ys[low] + (ys[high] - ys[low]) * (at - low))


def test_reference_lines_and_dates(spark):
    rows = [(d("2020-01-01"), a, 0.1, int(a == 0), 1) for a in range(4)]
    df = report(spark, rows)
    got = sorted((r["line"], r["position"], r["x"], r["y"]) for r in ranking.reference_lines(df, "failure_event").collect())
    assert got == [("ideal", 1, 0.0, 0.0), ("ideal", 2, 0.25, 1.0), ("ideal", 3, 1.0, 1.0), ("random", 1, 0.0, 0.0), ("random", 2, 1.0, 1.0)]
    assert ranking.report_dates(df, [dt.date(2020, 1, 2)]).count() == 0
    assert ranking.report_dates(df, None).count() == 4


def test_scores_in_a_narrow_band(spark):
    """Ranges that hold much of a date are split, twice where need be, and give the same groups."""
    rng = random.Random(6)
    band = [0.5 + rng.random() / 100 for _ in range(3000)] + [0.7 + rng.random() * 1e-9 for _ in range(3000)] + [float("inf"), 1e300, -3.0, 0.0]
    rows = [(d("2020-01-01"), i, x, int(rng.random() < 0.3), 1) for i, x in enumerate(band)]
    scored = report(spark, rows)
    grouped = scored.groupBy("date", F.col("mdl_pred").alias("score")).agg(F.count("*").alias("n"))
    ranged = grouped.withColumn("range", ranking.score_range(F.col("score")))
    assert ranged.groupBy("range").count().agg(F.max("count")).first()[0] > 500
    split = ranking.split_full(ranking.split_full(ranged, ["date"], ["range"], "a", 100), ["date"], ["range", "a"], "b", 100)
    sizes = [r["count"] for r in split.groupBy("range", "a", "b").count().collect()]
    assert sum(sizes) == len(band) and max(sizes) <= 2 * len(band) / 100
    whole, fine = (ranking.score_groups(scored, "mdl_pred", "failure_event", full_share=share, splits=splits) for share, splits in ((1, 0), (100, 2)))
    assert fine.count() == len(set(band)) and fine.exceptAll(whole).count() == 0
