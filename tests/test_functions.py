import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierline.functions import casting, money, vectors


@pytest.mark.parametrize(
    "text, value",
    [
        ("12", 12), ("-3", -3), ("+4", 4), (" 7 ", 7), ("\t8\n", 8), ("2.5", 2), ("-2.9", -2),
        ("3.", 3), (".5", 0), ("+.9", 0), ("0", 0), ("", None), (" ", None), ("-", None),
        ("abc", None), ("1e3", None), ("1.2.3", None), ("1,000", None), ("12x", None), (".", 0), (" -7.25 ", -7), ("1.x", None), ("--1.0", None),
        ("2147483647", 2147483647), ("2147483648", None), ("-2147483648", -2147483648),
        ("99999999999.5", None), (None, None), ("1 2", None),
    ],
)
def test_int_or_null(spark, text, value):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(casting.int_or_null(F.col("t"))).first()[0] == value


def test_other_casts_give_null_for_bad_input(spark):
    df = spark.createDataFrame([("abc", "not-a-date", " USD ", " Us ")], "d STRING, t STRING, c STRING, n STRING")
    row = df.select(
        casting.double_or_null(F.col("d")),
        casting.timestamp_or_null(F.col("t")),
        casting.trimmed(F.col("c")),
        casting.normalized(F.col("n")),
    ).first()
    assert tuple(row) == (None, None, "USD", "us")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_do_not_depend_on_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("2.5", "x", "1.5")], "q STRING, t STRING, p STRING")
        row = df.select(
            casting.int_or_null(F.col("q")),
            casting.timestamp_or_null(F.col("t")),
            casting.double_or_null(F.col("p")),
        ).first()
        assert tuple(row) == (2, None, 1.5)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_below_infinity(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,), (math.nan,)], "x DOUBLE")
    assert [r[0] for r in df.select(casting.below_infinity(F.col("x"))).collect()] == [True, False, False]


def test_timestamp_text_shows_a_fraction_only_if_there_is_one(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 1, 1, 10),), (datetime(2025, 1, 1, 10, 0, 0, 500000),)], "t TIMESTAMP_NTZ"
    )
    assert [r[0] for r in df.select(casting.timestamp_text(F.col("t"))).collect()] == [
        "2025-01-01 10:00:00",
        "2025-01-01 10:00:00.500000",
    ]


def test_money_sum_is_exact_in_any_order(spark):
    values = [(0.1,)] * 10 + [(1e9,), (-1e9,)]
    for parts in (1, 3, 7):
        df = spark.createDataFrame(values, "x DOUBLE").repartition(parts)
        assert df.agg(money.money_sum(F.col("x"))).first()[0] == 1.0


def test_money_sum_keeps_amounts_beyond_the_decimal(spark):
    df = spark.createDataFrame([(1e30,), (2.5,), (None,)], "x DOUBLE")
    assert df.agg(money.money_sum(F.col("x"))).first()[0] == pytest.approx(1e30)
    alone = spark.createDataFrame([(1e30,)], "x DOUBLE")
    assert alone.agg(money.money_sum(F.col("x"))).first()[0] == 1e30
    empty = spark.createDataFrame([(None,)], "x DOUBLE")
    assert empty.agg(money.money_sum(F.col("x"))).first()[0] is None


def test_money_sum_keeps_tiny_amounts_and_large_ones(spark):
    tiny = spark.createDataFrame([(4e-7,)] * 1000, "x DOUBLE")
    assert tiny.agg(money.money_sum(F.col("x"))).first()[0] == 0.0004
    large = [(1e25,), (3.0,), (-1e25,), (1e24,), (-1e24,)]
    for parts in (1, 3, 5):
        df = spark.createDataFrame(large, "x DOUBLE").repartition(parts)
        assert df.agg(money.money_sum(F.col("x"))).first()[0] == 3.0


def test_squared_l2(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0]), ([1.0], [1.0, 2.0])], "a ARRAY<FLOAT>, b ARRAY<FLOAT>")
    got = [r[0] for r in df.select(vectors.squared_l2(F.col("a"), F.col("b"))).collect()]
    assert got == [25.0, None]
