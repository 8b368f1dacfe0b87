"""A raw transaction feed over order tables, in the shape of the raw CSV files.

Every line item is one raw row. The same (order, line) occurs several times with
different payloads, so the feed has true duplicates. Some orders carry faults of the
kinds the gates look for: an empty customer, a negative quantity, an unreadable time
and a padded country.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Which orders carry a fault (order key modulo 50), and currency by region.
FAULT_CYCLE = 50
EMPTY_CUSTOMER, NEGATIVE_QUANTITY, BAD_TIME, PADDED_COUNTRY = 7, 11, 13, 17
CURRENCIES = {0: "USD", 1: "GBP", 2: "EUR", 3: "JPY"}
OTHER_CURRENCY = "AUD"

# Fixed value: rows shipped before this day form the first delivery, the others the second.
SECOND_DELIVERY = "1998-01-01"


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def first_delivery() -> Column:
    return F.col("l_shipdate") < F.lit(SECOND_DELIVERY).cast("timestamp_ntz")


def raw_feed(spark: SparkSession, sf_dir: str, delivered: Column | None = None) -> DataFrame:
    """All raw rows as strings, or those of one delivery."""
    lines = _table(
        spark,
        sf_dir,
        "lineitem",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
    )
    if delivered is not None:
        lines = lines.filter(delivered)
    orders = _table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customers = _table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nations = _table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    # Orders find their customers first: many fewer rows than lines, which are then shuffled once at most.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    rows = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )

    def fault(kind: int, broken: Column, sound: Column) -> Column:
        return F.when(F.col("l_orderkey") % FAULT_CYCLE == kind, broken).otherwise(sound)

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    currency = F.lit(OTHER_CURRENCY)
    for region, code in CURRENCIES.items():
        currency = F.when(F.col("n_regionkey") == region, F.lit(code)).otherwise(currency)
    return rows.select(
        F.concat(
            F.lit("T-"), F.lpad(text("l_orderkey"), 9, "0"), F.lit("-"), text("l_linenumber")
        ).alias("transaction_id"),
        fault(
            EMPTY_CUSTOMER, F.lit(""), F.concat(F.lit("C-"), F.lpad(text("o_custkey"), 7, "0"))
        ).alias("customer_id"),
        F.concat(F.lit("SKU-"), F.lpad(text("l_partkey"), 6, "0")).alias("product_id"),
        fault(
            NEGATIVE_QUANTITY, F.lit("-1"), F.col("l_quantity").cast("int").cast("string")
        ).alias("quantity"),
        text("l_extendedprice").alias("unit_price"),
        currency.alias("currency"),
        fault(BAD_TIME, F.lit("not-a-date"), text("l_shipdate")).alias("event_ts"),
        fault(
            PADDED_COUNTRY,
            F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")),
            F.col("n_name"),
        ).alias("country"),
    )


def write_csv(raw: DataFrame, folder: str, mode: str = "error") -> None:
    """The feed as CSV files with headers, blanks kept and empty fields left empty."""
    raw.write.mode(mode).options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue=""
    ).csv(folder)
