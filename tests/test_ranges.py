"""Lag features of series cut into ranges, compared with one window over each series."""

import random
from datetime import date, timedelta

import pytest

from tierline.operators import features

MART = "event_date DATE, country STRING, gross_revenue DOUBLE, order_count BIGINT, unique_customers BIGINT"


def series(country, days, seed=0):
    chance = random.Random(f"{country} {seed}")
    picked = sorted(chance.sample(range(4000), days))
    return [
        (date(2020, 1, 1) + timedelta(d), country, chance.choice([None, round(chance.uniform(-9, 900), 2)] if chance.random() < 0.2 else [float(d)]), d, 1)
        for d in picked
    ]


@pytest.fixture(scope="module")
def daily(spark):
    rows = series("ch", 900) + series("at", 40) + series("li", 5) + series(None, 60) + [(None, "ch", 4.5, 1, 1), (None, "xx", 1.0, 1, 1)]
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, MART).repartition(5).cache()


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("rows, parts", [(1, 1024), (3, 1024), (50, 1024), (50, 4), (10_000, 1024)])
def test_same_as_one_window(daily, rows, parts):
    want = features.lag_features(daily)
    got = features.lag_features_by_ranges(daily, rows, parts)
    assert got.columns == want.columns
    assert sorted_rows(got) == sorted_rows(want) != []


def test_ranges_have_no_gap_and_bounded_rows(daily):
    sizes = {}
    for r in features.ranges(daily, 50).groupBy("country", "_range").count().collect():
        sizes.setdefault(r["country"], {})[r["_range"]] = r["count"]
    assert max(max(s.values()) for s in sizes.values()) <= 60
    for s in sizes.values():
        assert set(s) | {0} == set(range(max(s) + 1))
    assert len(sizes["ch"]) >= 18 and len(sizes["li"]) == len(sizes["xx"]) == 1


def test_no_window_over_a_whole_series(daily):
    plan = features.lag_features_by_ranges(daily, 50)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" +-:|!").startswith("Window ")]
    assert len(windows) == 2
    assert all("_range" in line.split("windowspecdefinition(")[1] for line in windows)


def test_empty_mart(spark):
    assert features.lag_features_by_ranges(spark.createDataFrame([], MART)).count() == 0
