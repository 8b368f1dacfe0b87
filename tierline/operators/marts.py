"""Gold marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.money import money_sum


def daily_revenue(silver: DataFrame) -> DataFrame:
    """Revenue, orders and distinct customers per day and country.

    Spark first reduces to (day, country, customer) on both sides of the shuffle, so a
    busy country is spread over its customers.
    """
    return silver.groupBy(F.to_date("event_ts").alias("event_date"), "country").agg(
        money_sum(F.col("revenue")).alias("gross_revenue"),
        F.count("transaction_id").alias("order_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def customer_ltv(silver: DataFrame) -> DataFrame:
    """Lifetime revenue, orders and first and last purchase per customer.

    Amounts of different currencies are added as they stand.
    """
    return silver.groupBy("customer_id").agg(
        money_sum(F.col("revenue")).alias("lifetime_revenue"),
        F.count("transaction_id").alias("orders"),
        F.min("event_ts").alias("first_seen"),
        F.max("event_ts").alias("last_seen"),
    )


def daily_narrow(silver: DataFrame) -> DataFrame:
    """Revenue alone, by the stored event date."""
    return silver.groupBy("event_date", "country").agg(
        money_sum(F.col("revenue")).alias("gross_revenue")
    )


def by_day(daily: DataFrame) -> DataFrame:
    return daily.orderBy("event_date", "country")


def by_value(ltv: DataFrame) -> DataFrame:
    """Most valuable customers first; ids settle ties and split equal values over tasks."""
    return ltv.orderBy(F.col("lifetime_revenue").desc(), "customer_id")
