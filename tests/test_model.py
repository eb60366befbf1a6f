import datetime as dt
import random

import pytest
from fleet import d
from pyspark.sql import functions as F

from assetpulse.operators import model, ranking

FIRST = d("2020-01-01")


@pytest.fixture(scope="module")
def data(spark):
    """Failure depends on the work since maintenance; the names and gaps exercise the preparation."""
    rng = random.Random(4)
    rows = []
    for a in range(12):
        for i in range(90):
            load = rng.randrange(100)
            rows.append(
                (
                    a, FIRST + dt.timedelta(i), load, float("inf") if i == 0 else load / 2, rng.randrange(5) or None,
                    int(load > 70), 7, "g", "c", "t", rng.choice(["S1", "S9"]), "M1",
                )
            )
    schema = (
        "customer_asset_identifier long, date date, notes_in_last_pm long, Avg_notes_in double, firmwareHistory int, "
        "failure_event int, day_to_failure int, model_group_name string, category_name string, type_name string, "
        "security_type string, model_name string"
    )
    facts = spark.createDataFrame(rows, schema)
    security = spark.createDataFrame([("S1", 1)], "security_type string, id int")
    names = spark.createDataFrame([("M1", 3)], "model_name string, id int")
    return model.prepare(facts, security, names, last_date="2020-03-30").cache()


def test_prepare(data):
    assert set(data.columns) == {
        "customer_asset_identifier", "date", "notes_in_last_pm", "Avg_notes_in", "firmwareHistory",
        "failure_event", "security_type", "model_name",
    }
    assert data.filter("security_type IN (0, 1) AND model_name = 3").count() == data.count() == 12 * 90
    assert data.filter(F.col("date") == FIRST).agg(F.max("Avg_notes_in")).first()[0] == 0.0
    assert data.filter("firmwareHistory IS NULL").count() == 0


def test_split(data):
    train, test = model.time_split(data, "2020-02-29")
    sizes = {row["part"]: row["rows"] for row in model.split_counts(train, test).collect()}
    assert sizes == {"train": 12 * 60, "test": 12 * 30}
    held, _ = model.time_split(data, "2020-02-29", embargo_days=30)
    assert held.agg(F.max("date")).first()[0] == d("2020-01-30")


def test_forest(spark, data, tmp_path):
    run = model.run_model(data, "2020-02-29", name="forest", trees=10)
    row = run.metrics.first()
    assert row["Modelname"] == "forest" and row["recall"] > 0.9 and row["precision"] > 0.9
    probability = run.predictions.agg(F.min("failure_probability"), F.max("failure_probability")).first()
    assert 0 <= probability[0] <= probability[1] <= 1
    assert run.report.select("date").distinct().collect() == [(d("2020-03-30"),)]
    groups = ranking.score_groups(run.report, "mdl_pred", "failure_event")
    assert ranking.roc_auc(groups).first()["roc_auc"] > 0.5

    def values(predictions):
        return sorted((r["date"], r["customer_asset_identifier"], round(r["failure_probability"], 9)) for r in predictions.collect())

    train, test = model.time_split(data, "2020-02-29")
    again = model.predict(model.fit_forest(train, trees=10), test)
    assert values(again) == values(run.predictions)
    features = model.feature_columns(train)
    model.save_model(run.model, str(tmp_path / "m"), features, "1.0", "2020-02-29", "2020-04-01")
    loaded = model.predict(model.load_model(str(tmp_path / "m")), test)
    assert values(loaded) == values(run.predictions)
    meta = spark.read.parquet(str(tmp_path / "m" / "metadata")).first()
    assert meta["feature_columns"] == features and meta["train_end"] == "2020-02-29"
    flipped = model.predict(run.model, test, output_transform=lambda c: 1 - c)
    assert flipped.agg(F.sum("prediction")).first()[0] == len(values(again)) - run.predictions.agg(F.sum("prediction")).first()[0]


def test_evaluate(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 0)] + [(1, 1)] * 4
    df = spark.createDataFrame(pairs, "failure_event int, prediction int")
    row = model.evaluate(df).first()
    assert row["costMatrix"] == 0  # 2 + 2 - 4
    assert (row["recall"], row["precision"], row["accuracy"]) == (0.8, pytest.approx(4 / 6), 0.75)
    assert tuple(model.confusion(df).first()) == (5, 2, 1, 4)
    none = model.evaluate(df.filter("failure_event = 0 AND prediction = 0")).first()
    assert (none["recall"], none["precision"], none["accuracy"], none["costMatrix"]) == (0.0, 0.0, 1.0, 0)
    days = spark.createDataFrame([(10, 30), (31, 5), (90, 31)], "failure_event int, prediction int")
    assert tuple(model.confusion(days, mode="regression").first()) == (1, 1, 0, 1)
    with pytest.raises(ValueError):
        model.evaluate(df, mode="other")


def test_class_weights_balance(data):
    weighted = model.with_class_weight(data)
    sums = [row[1] for row in weighted.groupBy("failure_event").agg(F.sum("weight")).collect()]
    assert sums[0] == pytest.approx(sums[1])
