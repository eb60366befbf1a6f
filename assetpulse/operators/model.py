"""Failure model: input preparation, time split, forest, evaluation and storage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetpulse.constants import ASSET, COST, DATE, DEVICE_COLUMNS
from assetpulse.functions import as_date, at_most, date_label, numbers_filled, ratio
from assetpulse.operators import forest
from assetpulse.operators.filters import between_dates
from assetpulse.operators.joins import encode, first_per_key

LABEL = "failure_event"
NAME_COLUMNS = ["model_group_name", "category_name", "type_name"]
FIRST_DATE = "2015-01-01"
TEST_DAYS = 30
FALLBACK_DAYS = 30


def day_after(day: dt.date | str, days: int) -> dt.date:
    return dt.date.fromisoformat(str(day)[:10]) + dt.timedelta(days)


def prepare(
    facts: DataFrame,
    security_map: DataFrame,
    model_map: DataFrame,
    last_date: dt.date | str,
    first_date: dt.date | str = FIRST_DATE,
) -> DataFrame:
    """Model input: names encoded or dropped, infinities and nulls 0, day_to_failure removed."""
    kept = between_dates(facts, first_date, last_date).drop(*NAME_COLUMNS, "day_to_failure")
    return numbers_filled(encode(encode(kept, security_map, "security_type"), model_map, "model_name"))


def encode_devices(features: DataFrame, security_map: DataFrame, model_map: DataFrame) -> DataFrame:
    """The device table, one row per product, with security type and model encoded and the other names dropped."""
    names = [name for name in DEVICE_COLUMNS if name in features.columns]
    devices = first_per_key(features, "product_identifier", names).drop(*NAME_COLUMNS)
    return encode(encode(devices, security_map, "security_type"), model_map, "model_name")


def time_split(
    data: DataFrame, train_end: dt.date | str, test_days: int = TEST_DAYS, embargo_days: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Train up to train_end, test the days after it. embargo_days leaves out the last training days, whose
    labels already look into the test period."""
    train = data.filter(F.col(DATE) <= as_date(day_after(train_end, -embargo_days)))
    test = data.filter((F.col(DATE) > as_date(train_end)) & (F.col(DATE) <= as_date(day_after(train_end, test_days))))
    return train, test


def split_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    def size(df, name):
        return df.agg(F.lit(name).alias("part"), F.count("*").alias("rows"))

    return size(train, "train").unionByName(size(test, "test"))


def feature_columns(data: DataFrame, label: str = LABEL) -> list[str]:
    return [name for name in data.columns if name not in (ASSET, DATE, label)]


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Both classes (1 and the rest, 0) with their rows and balanced weight n / (2 * rows); an empty class has the weight n / 2."""
    sizes = train.agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("positive"))
    classes = F.array(
        F.struct(F.lit(0).alias("class"), (F.col("n") - F.col("positive")).alias("rows")),
        F.struct(F.lit(1).alias("class"), F.col("positive").alias("rows")),
    )
    weight = F.col("n") / (F.lit(2.0) * F.greatest("rows", F.lit(1)))
    return sizes.select("n", F.inline(classes)).select("class", "rows", weight.alias("weight"))


def with_class_weight(train: DataFrame, label: str = LABEL, output: str = "weight", sizes: Sequence[Row] | None = None) -> DataFrame:
    """Balanced weights, from the two rows of class_weights; sizes are those rows, where they are known."""
    weights = {row["class"]: row["weight"] for row in sizes or class_weights(train, label).collect()}
    return train.withColumn(output, F.when(F.col(label) == 1, weights[1]).otherwise(weights[0]))


def fit_forest(
    train: DataFrame, label: str = LABEL, trees: int = 100, depth: int = 7, seed: int = 42
) -> PipelineModel:
    """Random forest with balanced classes and sqrt(features) per split."""
    features = feature_columns(train, label)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    assembler.transform(train)  # refuses columns that are no numbers
    settings = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    sizes = class_weights(train, label).collect()
    weighted = with_class_weight(train, label, settings.getWeightCol(), sizes)
    return PipelineModel([assembler, forest.fit(weighted, features, settings, sum(row["rows"] for row in sizes))])


def predict(
    model: PipelineModel, test: DataFrame, label: str = LABEL, output_transform: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Predicted class and failure probability per test row; output_transform may rewrite the class."""
    scored = model.transform(test)
    predicted = F.col("prediction")
    if output_transform is not None:
        predicted = output_transform(predicted)
    return scored.select(
        DATE,
        ASSET,
        label,
        "notes_in_last_pm",
        predicted.alias("prediction"),
        vector_to_array("probability")[1].alias("failure_probability"),
    )


def prediction_slice(predictions: DataFrame, dates: Sequence[dt.date | str]) -> DataFrame:
    days = [dt.date.fromisoformat(str(day)[:10]) for day in dates]
    return (
        predictions.filter(F.col(DATE).isin(days))
        .select(DATE, ASSET, F.col("failure_probability").alias("mdl_pred"))
    )


def score_report(
    test: DataFrame, predictions: DataFrame, dates: Sequence[dt.date | str], label: str = LABEL
) -> DataFrame:
    """Label, work since maintenance and score of each asset at the report dates."""
    days = [dt.date.fromisoformat(str(day)[:10]) for day in dates]
    truth = test.filter(F.col(DATE).isin(days)).select(DATE, ASSET, label, "notes_in_last_pm")
    return truth.join(prediction_slice(predictions, dates), [DATE, ASSET])


def confusion(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction", mode: str = "classification") -> DataFrame:
    """Confusion counts as one row. mode='regression' first turns both sides into 'at most 30 days'."""
    truth, guess = F.col(label), F.col(prediction)
    if mode == "regression":
        truth, guess = at_most(truth, FALLBACK_DAYS), at_most(guess, FALLBACK_DAYS)
    elif mode != "classification":
        raise ValueError("mode is 'classification' or 'regression'")
    yes, hit = truth == 1, guess == 1
    return predictions.agg(
        F.count_if(~yes & ~hit).alias("tn"),
        F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"),
        F.count_if(yes & hit).alias("tp"),
    )


def evaluate(
    predictions: DataFrame, label: str = LABEL, prediction: str = "prediction", mode: str = "classification"
) -> DataFrame:
    """Recall, precision, accuracy and cost; an undefined ratio is 0."""
    counts = confusion(predictions, label, prediction, mode)
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    cost = sum((F.col(name) * weight for name, weight in COST.items()), F.lit(0))

    def defined(top: Column, bottom: Column) -> Column:
        return F.coalesce(ratio(top, bottom), F.lit(0.0))

    return counts.select(
        defined(tp, tp + fn).alias("recall"),
        defined(tp, tp + fp).alias("precision"),
        defined(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        cost.alias("costMatrix"),
    )


def results_table(results: dict[str, DataFrame]) -> DataFrame:
    """One row of metrics per model."""
    tables = [metrics.withColumn("Modelname", F.lit(name)) for name, metrics in results.items()]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def save_model(
    model: PipelineModel, path: str, features: Sequence[str], version: str, train_end: dt.date | str, trained_on: dt.date | str
) -> None:
    """Model under path/model and its one-row description under path/metadata."""
    model.write().overwrite().save(f"{path}/model")
    meta = SparkSession.active().range(1).select(
        F.lit(version).alias("version"),
        date_label(as_date(train_end)).alias("train_end"),
        date_label(as_date(trained_on)).alias("trained_on"),
        F.array(*[F.lit(name) for name in features]).alias("feature_columns"),
    )
    meta.write.mode("overwrite").parquet(f"{path}/metadata")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


@dataclass(frozen=True)
class StoredModel:
    """A model read back with its description; it scores tables that have its features, whatever else they have."""

    model: PipelineModel
    version: str
    train_end: str
    trained_on: str
    features: tuple[str, ...]

    def check(self, data: DataFrame) -> None:
        """Raises ValueError where data lacks a feature, has it in a kind a model cannot read, or has numeric columns that a
        model trained on data like it would also have used (a newer table, an older model)."""
        kinds = {field.name: field.dataType for field in data.schema.fields}
        missing = [name for name in self.features if name not in kinds]
        odd = [name for name in self.features if name in kinds and not isinstance(kinds[name], (T.NumericType, T.BooleanType))]
        new = [name for name in feature_columns(data) if name not in self.features and isinstance(kinds[name], T.NumericType)]
        faults = {"missing": missing, "not numeric": odd, "unknown to the model": new}
        if any(faults.values()):
            raise ValueError("features do not fit: " + "; ".join(f"{what} {names}" for what, names in faults.items() if names))

    def predict(self, data: DataFrame, label: str = LABEL) -> DataFrame:
        self.check(data)
        return predict(self.model, data, label)


def read_model(path: str) -> StoredModel:
    """Model and description from path, as save_model wrote them."""
    meta = SparkSession.active().read.parquet(f"{path}/metadata").first()
    return StoredModel(load_model(path), meta["version"], meta["train_end"], meta["trained_on"], tuple(meta["feature_columns"]))


@dataclass(frozen=True)
class ModelRun:
    model: PipelineModel
    predictions: DataFrame
    report: DataFrame
    metrics: DataFrame


def run_model(
    prepared: DataFrame, train_end: dt.date | str, name: str = "random forest", embargo_days: int = 0, trees: int = 100,
    store: str | None = None, version: str = "1", trained_on: dt.date | str | None = None,
) -> ModelRun:
    """Split, fit, predict, report the last test date and evaluate. With store, the model is saved there with its features and
    read back, and the stored model makes the predictions."""
    train, test = time_split(prepared, train_end, embargo_days=embargo_days)
    model = fit_forest(train, trees=trees)
    if store is None:
        predictions = predict(model, test)
    else:
        save_model(model, store, feature_columns(train), version, train_end, trained_on or dt.date.today())
        stored = read_model(store)
        model, predictions = stored.model, stored.predict(test)
    report = score_report(test, predictions, [day_after(train_end, TEST_DAYS)])
    return ModelRun(model, predictions, report, results_table({name: evaluate(predictions)}))
