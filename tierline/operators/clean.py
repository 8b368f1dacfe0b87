"""From raw strings to typed, gated, deduplicated transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierline.functions.casting import (
    below_infinity,
    double_or_null,
    int_or_null,
    normalized,
    timestamp_or_null,
    trimmed,
)
from tierline.schemas import RAW_COLUMNS, SILVER_COLUMNS

KEY = "transaction_id"


# What tells later deliveries from earlier ones, where a frame has it: a mark of the upsert and
# the version of the Bronze batch.
DELIVERY = ("_delivered", "ingest_version")


def typed(raw: DataFrame, keep: tuple[str, ...] = (), keep_raw: bool = False) -> DataFrame:
    """The eight transaction columns with their types; unreadable values are NULL.

    ``keep`` carries further columns along. ``keep_raw`` adds the strings as they came
    in a ``_raw`` struct; it costs nothing where it is not selected later.
    """
    columns = [
        F.col("transaction_id"),
        F.col("customer_id"),
        F.col("product_id"),
        int_or_null(F.col("quantity")).alias("quantity"),
        double_or_null(F.col("unit_price")).alias("unit_price"),
        trimmed(F.col("currency")).alias("currency"),
        timestamp_or_null(F.col("event_ts")).alias("event_ts"),
        normalized(F.col("country")).alias("country"),
        *[F.col(c) for c in keep],
    ]
    if keep_raw:
        columns.append(F.struct(*RAW_COLUMNS).alias("_raw"))
    return raw.select(*columns)


def gates(finite_price: bool = True) -> dict[str, Column]:
    """What a clean row fulfils, by the reason given when it does not; NULL means it does not.

    ``finite_price`` also refuses NaN and infinity, which pass ``>= 0`` and spoil sums.
    """
    price = F.col("unit_price") >= 0
    if finite_price:
        price = price & below_infinity(F.col("unit_price"))
    return {
        "transaction_id missing": F.col("transaction_id").isNotNull(),
        "event_ts unreadable": F.col("event_ts").isNotNull(),
        "quantity not positive": F.col("quantity") > 0,
        "unit_price not valid": price,
        "customer_id missing": F.col("customer_id") != "",
    }


def _fails(condition: Column) -> Column:
    """True where a condition is false or NULL, so clean and rejected rows are complements."""
    return ~F.coalesce(condition, F.lit(False))


def clean_rows(rows: DataFrame, finite_price: bool = True) -> DataFrame:
    return rows.filter(reduce(Column.__and__, gates(finite_price).values()))


def rejected_rows(rows: DataFrame, finite_price: bool = True) -> DataFrame:
    """The complement of ``clean_rows`` with every reason, in gate order, and the time."""
    passes = gates(finite_price)
    failed = F.array_compact(
        F.array(*[F.when(_fails(ok), F.lit(reason)) for reason, ok in passes.items()])
    )
    return (
        rows.filter(_fails(reduce(Column.__and__, passes.values())))
        .withColumn("_reason", failed)
        .withColumn("_rejected_at", F.current_timestamp())
    )


def _delivery(raw: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in DELIVERY if c in raw.columns)


def deduplicated(rows: DataFrame) -> DataFrame:
    """One row per transaction: the latest, of the same time the last delivered.

    Further ties are settled by the remaining columns.

    The order covers the whole payload, so any two runs keep the same row. Spark keeps
    the first row per key before the shuffle already, so a key with very many copies
    sends one row per task.
    """
    deliveries = [F.col(c).desc_nulls_last() for c in DELIVERY if c in rows.columns]
    order = W.partitionBy(KEY).orderBy(
        F.col("event_ts").desc_nulls_last(),
        *deliveries,
        *[
            F.col(c).asc_nulls_last()
            for c in ("product_id", "quantity", "unit_price", "customer_id", "country", "currency")
        ],
    )
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def derived(rows: DataFrame) -> DataFrame:
    """Revenue, event date and ingest time."""
    return rows.withColumns(
        {
            "revenue": F.col("quantity") * F.col("unit_price"),
            "event_date": F.to_date("event_ts"),
            "ingest_ts": F.current_timestamp(),
        }
    )


def silver(raw: DataFrame, finite_price: bool = True) -> DataFrame:
    """Clean Silver rows: gates first, so a bad copy never displaces a good one."""
    kept = deduplicated(clean_rows(typed(raw, _delivery(raw)), finite_price))
    return derived(kept).select(*SILVER_COLUMNS)


def silver_before_rules(raw: DataFrame) -> DataFrame:
    """Silver rows for declared rules: deduplicated first, not gated."""
    return derived(deduplicated(typed(raw, _delivery(raw)))).select(*SILVER_COLUMNS)


def silver_rejects(raw: DataFrame, bronze: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rejected rows with reasons, raw strings and the Bronze table they came from."""
    return rejected_rows(typed(raw, keep, keep_raw=True)).withColumn(
        "_bronze_source", F.lit(bronze)
    )
