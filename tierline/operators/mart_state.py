"""What marts are made of, in a form that can be added up and taken away.

``customer_days`` holds a row for each customer, day and country; a day's rows depend on that day's sales only.
``customer_totals`` holds a row for each customer. Both marts follow from them exactly, so a change of some days
costs those days, not the whole history. The sums are decimals, so the order of changes leaves no trace.

Amounts from 1e22 up have no exact sum here; ``beyond`` counts them, and a caller that finds some takes the marts
from the sales themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.money import FINE_TYPE, SUM_TYPE, money_of, money_state

MONTH = "event_month"
_SUMS = {"exact": SUM_TYPE, "fine": FINE_TYPE, "amounts": "bigint", "beyond": "bigint", "orders": "bigint", "sales": "bigint"}
_DAY = ("customer_id", "event_date", "country")


def customer_days(silver: DataFrame) -> DataFrame:
    """One row for each customer, day and country, with the month as a column to partition by."""
    day = F.to_date("event_ts").alias("event_date")
    state = {
        **money_state(F.col("revenue")),
        "orders": F.count("transaction_id"),
        "sales": F.count(F.lit(1)),
        "first_seen": F.min("event_ts"),
        "last_seen": F.max("event_ts"),
    }
    rows = silver.groupBy("customer_id", day, "country").agg(*[c.alias(n) for n, c in state.items()])
    return rows.withColumn(MONTH, F.date_format("event_date", "yyyy-MM"))


def customer_totals(days: DataFrame) -> DataFrame:
    """One row for each customer, of any part of ``customer_days``."""
    sums = [F.sum(n).cast(t).alias(n) for n, t in _SUMS.items()]
    return days.groupBy("customer_id").agg(*sums, F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def daily_of(days: DataFrame) -> DataFrame:
    """The daily mart. A customer has one row for a day and country, so customers are counted without a distinct."""
    amounts = money_of(F.sum("exact"), F.sum("fine"), F.sum("amounts"))
    return days.groupBy("event_date", "country").agg(
        amounts.alias("gross_revenue"),
        F.sum("orders").alias("order_count"),
        F.count("customer_id").alias("unique_customers"),
    )


def ltv_of(totals: DataFrame) -> DataFrame:
    """The customer mart."""
    amounts = money_of(F.col("exact"), F.col("fine"), F.col("amounts"))
    return totals.select("customer_id", amounts.alias("lifetime_revenue"), "orders", "first_seen", "last_seen")


def on_days(days: list[str | None], pattern: str = "yyyy-MM-dd") -> Column:
    """Whether a row is on one of ``days``; a NULL day is a day.

    ``days`` holds texts; with the pattern of a month, months. They are names of folders, which the driver holds
    anyway, so rows are told apart as they are read and none is shuffled for it.
    """
    named = [d for d in days if d is not None]
    day = F.date_format("event_date", pattern)
    return F.when(day.isNull(), F.lit(None in days)).otherwise(day.isin(named))


def moved_totals(totals: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """Totals after some days lost the rows that ``removed`` adds up, and got those of ``added``.

    ``_lost`` marks customers whose first or last purchase was among what went and is not settled by what
    came; only their days need be looked at again. Customers without any sale left are gone.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        columns = [c for c in rows.columns if c != "customer_id"]
        return rows.select(F.col("customer_id").alias(f"_{name}"), F.struct(*columns).alias(name))

    old, minus, plus = side(totals, "old"), side(removed, "minus"), side(added, "plus")
    change = minus.join(plus, F.col("_minus").eqNullSafe(F.col("_plus")), "full_outer").select(
        F.when(F.col("plus").isNull(), F.col("_minus")).otherwise(F.col("_plus")).alias("_change"), "minus", "plus"
    )
    both = old.join(change, F.col("_old").eqNullSafe(F.col("_change")), "full_outer")

    def moved(n: str, t: str) -> Column:
        parts = [F.coalesce(F.col(f"{s}.{n}"), F.lit(0).cast(t)) for s in ("old", "minus", "plus")]
        return (parts[0] - parts[1] + parts[2]).cast(t)

    first = F.least("old.first_seen", "plus.first_seen")
    last = F.greatest("old.last_seen", "plus.last_seen")
    untouched = F.col("minus").isNull()
    first_stays = untouched | (F.col("minus.first_seen") > F.col("old.first_seen")) | (F.col("plus.first_seen") <= F.col("old.first_seen"))
    last_stays = untouched | (F.col("minus.last_seen") < F.col("old.last_seen")) | (F.col("plus.last_seen") >= F.col("old.last_seen"))
    return both.select(
        F.when(F.col("old").isNull(), F.col("_change")).otherwise(F.col("_old")).alias("customer_id"),
        *[moved(n, t).alias(n) for n, t in _SUMS.items()],
        first.alias("first_seen"),
        last.alias("last_seen"),
        (~F.coalesce(first_stays & last_stays, F.lit(False))).alias("_lost"),
    ).where("sales > 0")
