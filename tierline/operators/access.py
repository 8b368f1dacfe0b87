"""Row filters and column masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def visible_rows(
    df: DataFrame, scope: DataFrame, analyst: str | None = None, is_admin: bool = False, column: str = "country"
) -> DataFrame:
    """All rows for an admin, else those whose country is in the analyst's scope.

    Without ``analyst`` it is the user of the session. ``scope`` has columns ``analyst`` and ``country``. Spark broadcasts it only below its
    size threshold, and shuffles with skew handling above.
    """
    if is_admin:
        return df
    who = F.current_user() if analyst is None else F.lit(analyst)
    allowed = scope.filter(F.col("analyst") == who).select(F.col("country").alias(column))
    return df.join(allowed, column, "left_semi").select(*df.columns)


def masked(c: Column, may_see: bool) -> Column:
    """The value for members of the group, its SHA-256 in hex for others."""
    return F.when(F.lit(may_see), c).otherwise(F.sha2(c, 256))


def with_masked_customer(df: DataFrame, may_see: bool) -> DataFrame:
    return df.withColumn("customer_id", masked(F.col("customer_id"), may_see))
