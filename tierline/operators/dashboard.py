"""Figures shown on a dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.money import money_sum


def kpis(daily: DataFrame, ltv: DataFrame) -> DataFrame:
    """One row: total revenue, orders and number of customers; zeros for empty marts."""
    customers = ltv.agg(F.count(F.lit(1))).scalar()
    return daily.agg(
        F.coalesce(money_sum(F.col("gross_revenue")), F.lit(0.0)).alias("gross_revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("bigint").alias("orders"),
    ).withColumn("unique_customers", customers)


def revenue_by_country(daily: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """Date by country matrix of revenue, 0 where there is none.

    Without ``countries`` their list is read from the mart first. Spark bounds it by
    ``spark.sql.pivotMaxValues`` and raises beyond, it never drops columns. With ``countries``,
    the column ``other`` holds the revenue of all that are not in the list.
    """
    if countries is not None:
        listed = F.coalesce(F.col("country").isin(countries), F.lit(False))
        daily = daily.withColumn("country", F.when(listed, F.col("country")).otherwise("other"))
        countries = [*countries, *(["other"] if "other" not in countries else [])]
    grouped = daily.groupBy("event_date").pivot("country", countries)
    return grouped.agg(money_sum(F.col("gross_revenue"))).na.fill(0.0).orderBy("event_date")


def top_customers(ltv: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` customers with the highest lifetime revenue; each task keeps ``n`` rows."""
    return ltv.orderBy(F.col("lifetime_revenue").desc(), "customer_id").limit(n)
