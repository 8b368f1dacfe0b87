"""Table contracts and the checks made against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)



def _contract(required: dict[str, DataType], optional: dict[str, DataType]) -> StructType:
    fields = [StructField(n, t, nullable=False) for n, t in required.items()]
    return StructType(fields + [StructField(n, t) for n, t in optional.items()])


# Column names, types and nullability of each layer.
RAW_TRANSACTIONS = _contract(
    {"transaction_id": StringType()},
    dict.fromkeys(
        ("customer_id", "product_id", "quantity", "unit_price", "currency", "event_ts", "country"),
        StringType(),
    ),
)
BRONZE_TRANSACTIONS = StructType(
    RAW_TRANSACTIONS.fields
    + [
        StructField("_source_file", StringType()),
        StructField("_source_hint", StringType()),
        StructField("_ingest_ts", TimestampType()),
    ]
)
SILVER_TRANSACTIONS = _contract(
    {
        "transaction_id": StringType(),
        "customer_id": StringType(),
        "product_id": StringType(),
        "quantity": IntegerType(),
        "unit_price": DoubleType(),
        "currency": StringType(),
        "event_ts": TimestampType(),
        "country": StringType(),
        "revenue": DoubleType(),
        "ingest_ts": TimestampType(),
    },
    {},
)
SILVER_PARTITION = "event_date"

RAW_COLUMNS = RAW_TRANSACTIONS.fieldNames()
SILVER_COLUMNS = SILVER_TRANSACTIONS.fieldNames() + [SILVER_PARTITION]


class SchemaMismatch(ValueError):
    """A frame does not fit the table it is written to."""


def enforce(df: DataFrame, contract: StructType, evolve: bool = False) -> DataFrame:
    """Return ``df`` in contract order, or raise if its columns do not fit.

    Missing columns and changed types are always refused. Unknown columns are
    refused unless ``evolve`` is set, in which case they follow the known ones.
    Types are compared, not nullability; use ``null_report`` for that.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    extra = [n for n in have if n not in want]
    problems = [f"missing column {n}" for n in want if n not in have]
    problems += [
        f"column {n} is {have[n].simpleString()}, expected {t.simpleString()}"
        for n, t in want.items()
        if n in have and have[n] != t
    ]
    if extra and not evolve:
        problems += [f"unknown column {n}" for n in extra]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*want, *extra)


def null_report(df: DataFrame, contract: StructType) -> DataFrame:
    """Rows ``(column_name, null_rows)`` for each required column, from one pass over ``df``."""
    required = [f.name for f in contract.fields if not f.nullable and f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in required])
    pairs = [c for n in required for c in (F.lit(n), F.col(n))]
    return counts.select(F.stack(F.lit(len(required)), *pairs).alias("column_name", "null_rows"))


def assert_not_null(df: DataFrame, contract: StructType) -> None:
    """Raise if a required column holds NULLs. Reads ``df`` once; at most one row per column returns."""
    broken = null_report(df, contract).filter("null_rows > 0").collect()
    if broken:
        raise SchemaMismatch(
            "; ".join(f"{r['null_rows']} NULLs in {r['column_name']}" for r in broken)
        )
