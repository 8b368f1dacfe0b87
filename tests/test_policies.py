"""Policies in SQL against the operators that apply them to frames."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from tierline.operators import access, policies

ROWS = [("K-1", "ch", 3.0, date(2031, 1, 1)), ("K-2", "li", 4.0, date(2031, 1, 2)), ("K-3", None, 5.0, date(2031, 1, 3)), (None, "ch", 6.0, None)]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(ROWS, "customer_id STRING, country STRING, revenue DOUBLE, day DATE")


@pytest.fixture
def tables(spark):
    scope = spark.createDataFrame([("ida", "ch"), ("ida", "ch"), ("jon", "li"), ("o'neil", "li")], "analyst STRING, country STRING")
    groups = spark.createDataFrame([("ida", "pii_readers"), ("root", "admins")], "member STRING, group_name STRING")
    return scope, groups


@pytest.mark.parametrize("user", ["ida", "jon", "root", "nobody", "o'neil"])
def test_the_view_shows_each_user_their_rows(spark, sales, tables, user):
    scope, groups = tables
    policies.install(spark, scope, groups, user)
    policies.secured_view(spark, "sales", sales, mask="customer_id")
    got = sorted(map(tuple, spark.sql("SELECT * FROM sales").collect()), key=str)
    seen = access.visible_rows(sales, scope, user, is_admin=user == "root")
    want = access.with_masked_customer(seen, may_see=user == "ida")
    assert got == sorted(map(tuple, want.select(sales.columns).collect()), key=str)
    assert spark.sql("SELECT sum(revenue) s FROM sales WHERE country = 'ch'").first()["s"] == (9.0 if user in ("ida", "root") else None)


def test_the_session_user_is_asked_by_default(spark, sales, tables):
    me = spark.range(1).select(F.current_user()).first()[0]
    scope = spark.createDataFrame([(me, "li")], "analyst STRING, country STRING")
    policies.install(spark, scope, tables[1].where("member <> 'root'"))
    policies.secured_view(spark, "mine", sales, mask="customer_id")
    assert [tuple(r)[:2] for r in spark.table("mine").collect()] == [(hashlib.sha256(b"K-2").hexdigest(), "li")]


def test_a_source_without_countries_is_masked_only(spark, sales, tables):
    policies.install(spark, *tables, "nobody")
    policies.secured_view(spark, "plain", sales.drop("country"), mask="customer_id")
    got = [r["customer_id"] for r in spark.table("plain").collect()]
    assert len(got) == 4 and got.count(None) == 1 and hashlib.sha256(b"K-1").hexdigest() in got
