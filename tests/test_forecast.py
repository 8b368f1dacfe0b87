from datetime import date, timedelta

import pytest

from tierline.operators import forecast
from tierline.sources import append_table

SCHEMA = "event_date DATE, country STRING, gross_revenue DOUBLE, order_count BIGINT, unique_customers BIGINT"


@pytest.fixture
def daily(spark):
    rows = [
        (date(2025, 1, 1) + timedelta(days=i), c, 100.0 * k + 10.0 * (i % 7), 5 + i % 7, 3)
        for k, c in enumerate(("us", "gb", "de"), 1)
        for i in range(40)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_split_repeats_under_any_partitioning(daily):
    rows = forecast.training_frame(daily)
    parts = []
    for n in (1, 5):
        train, test = forecast.split(rows.repartition(n))
        assert train.count() + test.count() == rows.count() == 99
        parts.append({tuple(r) for r in train.collect()})
    assert parts[0] == parts[1]
    assert 0.6 < len(parts[0]) / 99 < 0.95


def test_split_by_date(daily):
    train, test = forecast.split(forecast.training_frame(daily), cut="2025-02-01")
    assert train.agg({"event_date": "max"}).first()[0] == date(2025, 1, 31)
    assert test.agg({"event_date": "min"}).first()[0] == date(2025, 2, 1)


def test_metrics_against_plain_arithmetic(spark):
    pairs = [(1e9 + 3.0, 1e9 + 2.5), (1e9 - 0.5, 1e9), (1e9 + 2.0, 1e9 + 2.0), (1e9 + 7.0, 1e9 + 8.0)]
    row = forecast.error_metrics(spark.createDataFrame(pairs, "gross_revenue DOUBLE, prediction DOUBLE")).first()
    mean = sum(y for y, _ in pairs) / 4
    assert row["mae"] == pytest.approx(0.5)
    assert row["r2"] == pytest.approx(1 - sum((y - p) ** 2 for y, p in pairs) / sum((y - mean) ** 2 for y, _ in pairs))
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "gross_revenue DOUBLE, prediction DOUBLE")
    assert forecast.error_metrics(flat).first()["r2"] is None


def test_train_record_register_and_load(spark, daily, layout):
    first = forecast.train(daily, layout, trees=5, max_depth=3)
    again = forecast.train(daily.repartition(7), layout, trees=5, max_depth=3)
    runs = {r["run_id"]: r for r in append_table.read(spark, layout.runs).collect()}
    assert set(runs) == {first, again}
    run = runs[first]
    assert run["params"]["n_estimators"] == "5" and run["params"]["n_features"] == "6"
    assert int(run["params"]["train_rows"]) > 0
    assert run["features"] == forecast.FEATURES and "lag_7" in run["signature"]
    assert run["metrics"]["mae"] == pytest.approx(runs[again]["metrics"]["mae"])
    assert 0 <= run["metrics"]["mae"] < 100

    assert forecast.register(spark, layout) == 1
    assert forecast.register(spark, layout) == 2
    versions = {r["model_version"]: r["alias"] for r in forecast.registry(spark, layout).collect()}
    assert versions == {1: None, 2: "champion"}
    model = forecast.load_model(spark, layout)
    assert model.transform(forecast.training_frame(daily)).filter("prediction > 0").count() == 99


def test_no_rows_and_no_runs(spark, layout, daily):
    with pytest.raises(RuntimeError, match="too short"):
        forecast.train(daily.filter("event_date < '2025-01-05'"), layout)
    with pytest.raises(RuntimeError, match="no run"):
        forecast.register(spark, layout)


def test_unlimited_depth_is_the_deepest_spark_grows(daily):
    rows = forecast.training_frame(daily)
    with pytest.raises(ValueError, match="30"):
        forecast.fit(rows, trees=1, max_depth=None)


def test_best_run(spark, layout):
    for run, mae in (("b", 2.0), ("a", 2.0), ("c", 9.0), ("d", None)):
        forecast.record_run(spark, layout.runs, run, {}, {"mae": mae} if mae else {})
    forecast.record_run(spark, layout.runs, "z", {}, {"mae": 0.1}, model_name="another")
    runs = append_table.read(spark, layout.runs)
    assert [r["run_id"] for r in forecast.best_run(runs).collect()] == ["a"]
    assert forecast.best_run(runs.limit(0)).count() == 0
