import io
import math
from contextlib import redirect_stdout
from datetime import date, datetime

from conftest import CLEAN, REFUSED, ids
from pyspark.sql import functions as F

from tierline.operators import clean
from tierline.schemas import RAW_TRANSACTIONS, SILVER_COLUMNS


def test_country_is_normalised(raw):
    assert ids(clean.typed(raw), "country") == {"ch", "at"}


def test_split_is_exact(raw):
    rows = clean.typed(raw)
    good, bad = clean.clean_rows(rows), clean.rejected_rows(rows)
    assert ids(good) == CLEAN and ids(bad) == REFUSED
    assert good.count() + bad.count() == raw.count()


def test_reject_reasons_and_raw_strings(spark):
    rows = [
        ("Q-1", None, "JAR-8", "x", "-1", "CHF", "yesterday", "ch"),
        (None, "CU-5", "JAR-8", "4", "2", "CHF", "2031-07-09", "ch"),
    ]
    # The reader drops the NOT NULL of the contract, so NULL keys do arrive.
    df = spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in RAW_TRANSACTIONS.fieldNames()))
    got = {r["transaction_id"]: r for r in clean.silver_rejects(df, "bronze/t").collect()}
    assert got["Q-1"]["_reason"] == [
        "event_ts unreadable",
        "quantity not positive",
        "unit_price not valid",
        "customer_id missing",
    ]
    assert got["Q-1"]["_raw"]["event_ts"] == "yesterday"
    assert got["Q-1"]["_raw"]["quantity"] == "x"
    assert got["Q-1"]["_bronze_source"] == "bronze/t"
    assert got[None]["_reason"] == ["transaction_id missing"]
    assert got[None]["_rejected_at"] is not None


def test_nan_and_infinite_prices(spark):
    rows = [(f"Q-{p}", "CU-5", "JAR-8", "4", p, "CHF", "2031-07-09", "ch") for p in ("NaN", "1e400", "-0.01", "0", "1.5")]
    df = clean.typed(spark.createDataFrame(rows, RAW_TRANSACTIONS))
    assert ids(clean.clean_rows(df)) == {"Q-0", "Q-1.5"}
    lenient = clean.clean_rows(df, finite_price=False)
    assert ids(lenient) == {"Q-0", "Q-1.5", "Q-NaN", "Q-1e400"}
    assert clean.rejected_rows(df, finite_price=False).count() == 1
    assert any(math.isnan(r["unit_price"]) for r in lenient.collect())


def test_silver_row(raw):
    got = {r["transaction_id"]: r for r in clean.silver(raw).collect()}
    assert set(got) == CLEAN
    assert {k: round(r["revenue"], 9) for k, r in got.items()} == {"ORD-901": 25.2, "ORD-902": 34.5, "ORD-903": 16.0}
    assert got["ORD-902"]["event_date"] == date(2031, 3, 15) and got["ORD-902"]["currency"] == "EUR"
    assert got["ORD-902"]["event_ts"] == datetime(2031, 3, 15, 18, 20)
    assert clean.silver(raw).columns == SILVER_COLUMNS


def test_latest_copy_wins_whatever_the_partitioning(spark):
    rows = [
        ("Q-1", f"CU-{i % 5}", f"JAR-{i % 7}", str(1 + i % 3), "2.40", "CHF", f"2031-07-0{1 + i % 4} 06:00:00", "ch")
        for i in range(60)
    ]
    best = max(r[6] for r in rows)
    expected = min(((r[2], int(r[3]), r[1]) for r in rows if r[6] == best))
    df = spark.createDataFrame(rows, RAW_TRANSACTIONS)
    for parts in (1, 3, 8):
        got = clean.silver(df.repartition(parts, "customer_id")).collect()
        assert len(got) == 1
        assert (got[0]["product_id"], got[0]["quantity"], got[0]["customer_id"]) == expected


def test_gate_order_differs_between_the_two_silver_paths(spark):
    rows = [
        ("Q-1", "CU-5", "JAR-8", "2", "2.40", "CHF", "2031-07-01 06:00:00", "ch"),
        ("Q-1", "CU-5", "JAR-8", "-1", "2.40", "CHF", "2031-07-02 06:00:00", "ch"),
    ]
    df = spark.createDataFrame(rows, RAW_TRANSACTIONS)
    assert [r["quantity"] for r in clean.silver(df).collect()] == [2]
    assert [r["quantity"] for r in clean.silver_before_rules(df).collect()] == [-1]


def test_copies_are_reduced_before_the_shuffle(raw):
    out = io.StringIO()
    with redirect_stdout(out):
        clean.silver(raw).explain()
    plan = out.getvalue()
    partial, final = plan.rindex("WindowGroupLimit"), plan.index("WindowGroupLimit")
    exchange = plan.index("Exchange hashpartitioning(transaction_id")
    assert final < exchange < partial


def test_one_key_holding_most_rows(spark):
    hot = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("T-"), F.col("id"))).otherwise("T-hot").alias("transaction_id"),
        F.lit("C-1").alias("customer_id"),
        F.concat(F.lit("P-"), F.col("id")).alias("product_id"),
        F.lit("1").alias("quantity"),
        F.lit("1.0").alias("unit_price"),
        F.lit("USD").alias("currency"),
        F.lit("2025-01-01 00:00:00").alias("event_ts"),
        F.lit("us").alias("country"),
    )
    assert clean.silver(hot).count() == 6667 + 1


def test_of_one_time_the_last_delivery_wins(spark):
    row = ("T-9", "C-9", "P-9", {}, "3.50", "EUR", "2024-06-01 08:00:00", "fr", {})
    rows = [tuple(q if x == {} and i == 3 else v if x == {} else x for i, x in enumerate(row)) for q, v in (("2", 0), ("5", 1))]
    names = "transaction_id STRING, customer_id STRING, product_id STRING, quantity STRING, unit_price STRING, currency STRING, event_ts STRING, country STRING, ingest_version BIGINT"
    got = clean.silver(spark.createDataFrame(rows, names)).collect()
    assert [r["quantity"] for r in got] == [5]
