"""Forest forecaster of daily revenue, its run records and its registry."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.features import lag_features
from tierline.sources import append_table, snapshot_table
from tierline.sources.layout import Layout
from tierline.sources.scratch import staged

# Model interface and settings.
FEATURES = ["lag_1", "lag_7", "rolling_3", "day_of_week", "order_count", "unique_customers"]
LABEL = "gross_revenue"
PREDICTION = "prediction"
TREES = 200
MAX_DEPTH = 8
SEED = 42
TRAIN_TENTHS = 8
MODEL_NAME = "daily_revenue_forecaster"
ALIAS = "champion"

# Spark's forest takes no unlimited depth; this is the deepest it grows.
DEEPEST = 30
# Tasks that training rows are placed in. Bagging goes by task, so the number is fixed: the model
# does not depend on the cluster.
TRAIN_TASKS = 32

RUN_SCHEMA = (
    "run_id STRING, model_name STRING, params MAP<STRING, STRING>, metrics MAP<STRING, DOUBLE>, "
    "features ARRAY<STRING>, signature STRING, model_path STRING, finished_at TIMESTAMP"
)
VERSION_SCHEMA = (
    "name STRING, model_version BIGINT, run_id STRING, model_path STRING, created_at TIMESTAMP"
)
ALIAS_SCHEMA = "name STRING, alias STRING, model_version BIGINT"


class NoTrainingRows(RuntimeError):
    """The mart is empty or too short for the lags."""


class NoRuns(RuntimeError):
    """There is no run to register."""


def training_frame(daily: DataFrame) -> DataFrame:
    """Keys, features as doubles and the label."""
    return lag_features(daily).select(
        "country",
        "event_date",
        *[F.col(c).cast("double").alias(c) for c in FEATURES],
        F.col(LABEL).cast("double").alias(LABEL),
    )


def in_training_part() -> Column:
    """Repeatable 80/20 choice from the row's key, whatever the partitioning."""
    return F.pmod(F.xxhash64("country", "event_date", F.lit(SEED)), F.lit(10)) < TRAIN_TENTHS


def split(rows: DataFrame, cut: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test). With ``cut``, days before that date train, so no later day leaks in."""
    train = F.col("event_date") < F.lit(cut).cast("date") if cut else in_training_part()
    return rows.filter(train), rows.filter(~train)


def fit(train: DataFrame, trees: int = TREES, max_depth: int | None = MAX_DEPTH) -> PipelineModel:
    """Fit the forest; runs jobs. Rows are placed by key first, so bagging repeats.

    Spark grows no tree deeper than 30, so an unlimited depth is refused.
    """
    if max_depth is None or max_depth > DEEPEST:
        raise ValueError(f"max_depth {max_depth}: trees grow to {DEEPEST} at most")
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=LABEL,
        predictionCol=PREDICTION,
        numTrees=trees,
        maxDepth=max_depth,
        seed=SEED,
    )
    placed = train.repartition(TRAIN_TASKS, "country", "event_date").sortWithinPartitions(
        "country", "event_date"
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return Pipeline(stages=[assembler, forest]).fit(placed)


def error_metrics(
    predicted: DataFrame,
    label: str = LABEL,
    prediction: str = PREDICTION,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``(mae, r2, rows)`` in one row, or one row per ``by``; R2 is NULL if the label is constant.

    One pass: the spread of the label is a variance, which Spark merges from partial
    moments without the cancellation a difference of sums would bring.
    """
    y, p = F.col(label), F.col(prediction)
    sums = predicted.groupBy(*by).agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg((y - p) * (y - p)).alias("_residual"),
        F.var_pop(y).alias("_spread"),
        F.count(F.lit(1)).alias("rows"),
    )
    r2 = F.when(F.col("_spread") > 0, 1 - F.col("_residual") / F.col("_spread"))
    return sums.select(*by, "mae", r2.alias("r2"), "rows")


def train(
    daily: DataFrame,
    layout: Layout,
    trees: int = TREES,
    max_depth: int | None = MAX_DEPTH,
    cut: str | None = None,
) -> str:
    """Train on the mart, save the model, record the run and return its id.

    The features are computed once into the shared folder, since fitting reads them
    several times.
    """
    spark = daily.sparkSession
    run_id = uuid.uuid4().hex
    path = f"{layout.model_files}/{run_id}"
    with staged(training_frame(daily), "features") as rows:
        train_rows, test_rows = split(rows, cut)
        n_train = train_rows.count()
        if not n_train or test_rows.isEmpty():
            raise NoTrainingRows("daily revenue is empty or too short for lag features")
        model = fit(train_rows, trees, max_depth)
        scores = error_metrics(model.transform(test_rows)).first()
    model.write().save(path)
    signature = {
        "inputs": {c: "double" for c in FEATURES},
        "output": {PREDICTION: "double"},
    }
    record_run(
        spark,
        layout.runs,
        run_id,
        params={
            "n_estimators": str(trees),
            "max_depth": str(max_depth),
            "n_features": str(len(FEATURES)),
            "train_rows": str(n_train),
        },
        metrics={"mae": scores["mae"], "r2": scores["r2"]},
        signature=json.dumps(signature),
        model_path=path,
    )
    return run_id


def record_run(
    spark: SparkSession,
    runs: str,
    run_id: str,
    params: dict[str, str],
    metrics: dict[str, float | None],
    signature: str = "",
    model_path: str = "",
    model_name: str = MODEL_NAME,
) -> None:
    row = (
        run_id,
        model_name,
        params,
        metrics,
        FEATURES,
        signature,
        model_path,
        datetime.now(timezone.utc),
    )
    append_table.append(spark.createDataFrame([row], RUN_SCHEMA), runs, f"run-{run_id}")


def best_run(runs: DataFrame, metric: str = "mae", model_name: str = MODEL_NAME) -> DataFrame:
    """The run with the lowest metric, as one row, or none; runs without it come last."""
    return (
        runs.filter(F.col("model_name") == model_name)
        .orderBy(F.try_element_at("metrics", F.lit(metric)).asc_nulls_last(), "run_id")
        .limit(1)
    )


def load_model(spark: SparkSession, layout: Layout, alias: str = ALIAS) -> PipelineModel:
    """The model an alias points to."""
    chosen = registry(spark, layout).filter(F.col("alias") == alias).first()
    if chosen is None:
        raise NoRuns(f"no model has the alias {alias}")
    return PipelineModel.load(chosen["model_path"])


def registry(spark: SparkSession, layout: Layout) -> DataFrame:
    """Model versions with their alias, NULL where a version has none."""
    known = append_table.read(spark, layout.model_versions)
    aliases = snapshot_table.read(spark, layout.model_aliases)
    return known.join(aliases, ["name", "model_version"], "left").select(
        "name", "model_version", "alias", "run_id", "model_path"
    )


def register(
    spark: SparkSession, layout: Layout, name: str = MODEL_NAME, alias: str = ALIAS
) -> int:
    """Make the best run the next version of the model and move the alias to it."""
    if append_table.latest_version(spark, layout.runs) is None:
        raise NoRuns("train a model first, there is no run")
    best = best_run(append_table.read(spark, layout.runs), model_name=name).first()
    if best is None:
        raise NoRuns(f"train a model first, there is no run of {name}")
    last = None
    if append_table.latest_version(spark, layout.model_versions) is not None:
        known = append_table.read(spark, layout.model_versions).filter(F.col("name") == name)
        last = known.agg(F.max("model_version")).first()[0]
    version = (last or 0) + 1
    entry = (name, version, best["run_id"], best["model_path"], datetime.now(timezone.utc))
    append_table.append(
        spark.createDataFrame([entry], VERSION_SCHEMA),
        layout.model_versions,
        f"{name}-{version}",
    )
    snapshot_table.write_or_upsert(
        spark.createDataFrame([(name, alias, version)], ALIAS_SCHEMA),
        layout.model_aliases,
        ["name", "alias"],
    )
    return version
