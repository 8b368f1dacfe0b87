"""Checks over whole layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.money import money_sum


def audit_silver(silver: DataFrame) -> DataFrame:
    """One row: rows, NULL keys, non-positive quantities and surplus copies of a key."""
    per_key = silver.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(~F.coalesce(F.col("quantity") > 0, F.lit(False))).alias("bad_quantity"),
    )
    is_null = F.col("transaction_id").isNull()
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return per_key.agg(
        total.alias("rows"),
        F.coalesce(F.sum(F.when(is_null, F.col("copies"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum("bad_quantity"), F.lit(0)).alias("non_positive_quantity"),
        F.coalesce(F.sum(F.when(~is_null, F.col("copies") - 1)), F.lit(0)).alias("duplicate_keys"),
    )


def reconcile(daily: DataFrame, silver: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """One row: Gold and Silver revenue and whether they agree."""
    gold_total = daily.agg(money_sum(F.col("gross_revenue"))).scalar()
    return silver.agg(money_sum(F.col("revenue")).alias("silver_revenue")).select(
        gold_total.alias("gold_revenue"),
        "silver_revenue",
        (F.abs(gold_total - F.col("silver_revenue")) <= tolerance).alias("matches"),
    )


def row_counts(layers: dict[str, DataFrame | None]) -> DataFrame:
    """Rows ``(layer, rows)``; NULL for a layer that does not exist yet."""
    present = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
        if df is not None
    ]
    if not present:
        raise ValueError("no layer to count")
    spark = present[0].sparkSession
    absent = [(name, None) for name, df in layers.items() if df is None]
    if absent:
        present.append(spark.createDataFrame(absent, "layer STRING, rows BIGINT"))
    return reduce(DataFrame.union, present)
