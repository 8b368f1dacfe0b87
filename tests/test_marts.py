from datetime import date, datetime

import pytest

from tierline.operators import access, audit, dashboard, features, marts


@pytest.fixture
def silver(spark):
    return spark.createDataFrame(
        [
            ("ORD-1", "CU-9", datetime(2031, 6, 3, 6, 30), "ch", 12.5, 5, date(2031, 6, 3)),
            ("ORD-2", "CU-4", datetime(2031, 6, 3, 21), "ch", 7.25, 1, date(2031, 6, 3)),
            ("ORD-3", "CU-9", datetime(2031, 6, 3, 22), "ch", 0.5, 1, date(2031, 6, 3)),
            ("ORD-4", "CU-9", datetime(2031, 6, 8, 14), "li", 90.0, 3, date(2031, 6, 8)),
        ],
        "transaction_id STRING, customer_id STRING, event_ts TIMESTAMP, country STRING, "
        "revenue DOUBLE, quantity INT, event_date DATE",
    )


def test_daily_revenue(silver):
    got = [tuple(r) for r in marts.by_day(marts.daily_revenue(silver)).collect()]
    assert got == [
        (date(2031, 6, 3), "ch", 20.25, 3, 2),
        (date(2031, 6, 8), "li", 90.0, 1, 1),
    ]


def test_customer_ltv(silver):
    got = [tuple(r) for r in marts.by_value(marts.customer_ltv(silver)).collect()]
    assert got == [
        ("CU-9", 103.0, 3, datetime(2031, 6, 3, 6, 30), datetime(2031, 6, 8, 14)),
        ("CU-4", 7.25, 1, datetime(2031, 6, 3, 21), datetime(2031, 6, 3, 21)),
    ]


def test_narrow_mart_sums_by_stored_date(silver):
    got = {tuple(r) for r in marts.daily_narrow(silver).collect()}
    assert got == {(date(2031, 6, 3), "ch", 20.25), (date(2031, 6, 8), "li", 90.0)}


def test_audit_and_reconciliation(spark, silver):
    assert audit.audit_silver(silver).first().asDict() == {
        "rows": 4, "null_keys": 0, "non_positive_quantity": 0, "duplicate_keys": 0,
    }
    bad = spark.createDataFrame(
        [("T", 1), ("T", -1), ("T", None), (None, 1)], "transaction_id STRING, quantity INT"
    )
    assert audit.audit_silver(bad).first().asDict() == {
        "rows": 4, "null_keys": 1, "non_positive_quantity": 2, "duplicate_keys": 2,
    }
    assert audit.audit_silver(bad.limit(0)).first()["rows"] == 0
    daily = marts.daily_revenue(silver)
    assert audit.reconcile(daily, silver).first().asDict() == {
        "gold_revenue": 110.25, "silver_revenue": 110.25, "matches": True,
    }
    assert not audit.reconcile(daily.filter("country = 'ch'"), silver).first()["matches"]


@pytest.fixture
def daily(spark):
    return spark.createDataFrame(
        [(date(2025, 1, 1), "us", 100.0, 3), (date(2025, 1, 1), "gb", 50.0, 2), (date(2025, 1, 2), "us", 25.0, 1)],
        "event_date DATE, country STRING, gross_revenue DOUBLE, order_count BIGINT",
    )


@pytest.fixture
def ltv(spark):
    return spark.createDataFrame(
        [("c2", 300.0, 3), ("c1", 500.0, 5), ("c3", 100.0, 1)],
        "customer_id STRING, lifetime_revenue DOUBLE, orders BIGINT",
    )


def test_kpis(daily, ltv):
    assert tuple(dashboard.kpis(daily, ltv).first()) == (175.0, 6, 3)
    assert tuple(dashboard.kpis(daily.limit(0), ltv.limit(0)).first()) == (0.0, 0, 0)


def test_pivot(daily):
    for countries in (None, ["gb", "us"]):
        got = dashboard.revenue_by_country(daily, countries)
        assert got.columns == ["event_date", "gb", "us", *(["other"] if countries else [])]
        none = (0.0,) if countries else ()
        assert [tuple(r) for r in got.collect()] == [
            (date(2025, 1, 1), 50.0, 100.0, *none),
            (date(2025, 1, 2), 0.0, 25.0, *none),
        ]


def test_pivot_keeps_countries_outside_the_list(daily):
    got = dashboard.revenue_by_country(daily, ["gb"]).collect()
    assert [(r["gb"], r["other"]) for r in got] == [(50.0, 100.0), (0.0, 25.0)]


def test_top_customers(ltv):
    assert [r["customer_id"] for r in dashboard.top_customers(ltv, 2).collect()] == ["c1", "c2"]
    assert dashboard.top_customers(ltv).count() == 3


def test_lag_features(spark):
    rows = [
        (date(2031, 9, 4 + 2 * i), c, s * (i * i + 0.5), 2 * i, i)
        for c, s in (("ch", 1.0), ("at", 1000.0))
        for i in range(9)
    ]
    df = spark.createDataFrame(
        rows, "event_date DATE, country STRING, gross_revenue DOUBLE, order_count BIGINT, unique_customers BIGINT"
    )
    got = {r["gross_revenue"]: r for r in features.lag_features(df.repartition(3)).filter("country = 'ch'").collect()}
    assert set(got) == {49.5, 64.5}
    row = got[64.5]
    assert (row["lag_1"], row["lag_7"]) == (49.5, 1.5) and row["rolling_3"] == pytest.approx((49.5 + 36.5 + 25.5) / 3)
    assert row["day_of_week"] == 5  # a Saturday, Monday being 0


def test_incomplete_rows_are_dropped(spark):
    rows = [(date(2025, 1, 1 + i), "us", float(i), i if i != 9 else None, 1) for i in range(12)]
    df = spark.createDataFrame(
        rows, "event_date DATE, country STRING, gross_revenue DOUBLE, order_count BIGINT, unique_customers BIGINT"
    )
    assert [r["gross_revenue"] for r in features.lag_features(df).collect()] == [7.0, 8.0, 10.0, 11.0]


def test_row_filter(spark, daily):
    scope = spark.createDataFrame(
        [("ann", "gb"), ("ann", "gb"), ("bob", "us")], "analyst STRING, country STRING"
    )
    seen = access.visible_rows(daily, scope, "ann")
    assert seen.columns == daily.columns
    assert [r["country"] for r in seen.collect()] == ["gb"]
    assert access.visible_rows(daily, scope, "eve").count() == 0
    assert access.visible_rows(daily, scope, "eve", is_admin=True).count() == 3


def test_column_mask(ltv):
    import hashlib

    hidden = {r["customer_id"] for r in access.with_masked_customer(ltv, may_see=False).collect()}
    assert hidden == {hashlib.sha256(c.encode()).hexdigest() for c in ("c1", "c2", "c3")}
    shown = {r["customer_id"] for r in access.with_masked_customer(ltv, may_see=True).collect()}
    assert shown == {"c1", "c2", "c3"}
