"""Lag features over the daily revenue mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: The furthest row a feature looks back to.
BACK = 7
#: Parts that quantiles cut a series into, of which short series join some; the error of a cut, as a share of a part.
PARTS, CUT_ERROR = 1024, 0.1


def _features(daily: DataFrame, series: WindowSpec) -> DataFrame:
    def back(n: int):
        return F.lag("gross_revenue", n).over(series)

    return (
        daily.withColumns({"lag_1": back(1), "lag_7": back(BACK), "_2": back(2), "_3": back(3)})
        .withColumn("rolling_3", (F.col("_3") + F.col("_2") + F.col("lag_1")) / 3)
        .withColumn("day_of_week", F.weekday("event_date"))
        .drop("_2", "_3")
    )


def lag_features(daily: DataFrame) -> DataFrame:
    """Lags 1 and 7, mean of the three rows before, day of week; incomplete rows dropped.

    Lags count rows of a country, not calendar days. One window serves all of them. It
    puts a country's series in one task, which the mart's grain bounds by the number of
    days; ``lag_features_by_ranges`` is for series longer than that. The mean is NULL unless three rows precede.
    """
    return _features(daily, W.partitionBy("country").orderBy("event_date")).na.drop()


def ranges(daily: DataFrame, rows: int, parts: int = PARTS) -> DataFrame:
    """``daily`` with a column ``_range``: ranges of about ``rows`` rows that follow the days of a country.

    A series of more than ``rows * parts`` rows has ``parts`` ranges, which are longer. They are numbered from 0 without a gap (range 0 may be empty) and cut at quantiles from sketches, which are merged
    per country before the shuffle. Rows of one day stay together.
    """
    shares = [i / parts for i in range(1, parts)]
    cuts = daily.groupBy("country").agg(
        F.percentile_approx("event_date", shares, int(parts / CUT_ERROR)).alias("_cuts"), F.count("*").alias("_n")
    )
    step = F.greatest(F.lit(1), (F.lit(rows * parts) / F.col("_n")).cast("int"))
    thinned = F.array_distinct(F.filter("_cuts", lambda c, i: (i + 1) % step == 0))
    cuts = cuts.select(F.col("country").alias("_country"), F.coalesce(thinned, F.array().cast("array<date>")).alias("_cuts"))
    placed = daily.join(cuts, F.col("country").eqNullSafe(F.col("_country")))
    return placed.withColumn("_range", F.size(F.filter("_cuts", lambda c: c <= F.col("event_date")))).drop("_cuts", "_country")


def lag_features_by_ranges(daily: DataFrame, rows: int = 1_000_000, parts: int = PARTS) -> DataFrame:
    """The rows of ``lag_features`` for long series: a window holds one of the ``ranges`` of a series, not all of it.

    Every range gets the last seven rows of each of the seven ranges before it. As a range holds at least one
    row, these contain the seven rows before its first. A NULL country is a series of its own; rows without
    a day come first.
    """
    placed = ranges(daily, rows, parts)
    latest = W.partitionBy("country", "_range").orderBy(F.desc("event_date"))
    tails = placed.select("country", "event_date", "gross_revenue", "_range").withColumn("_nth", F.row_number().over(latest))
    carried = (
        tails.where(F.col("_nth") <= BACK)
        .withColumn("_range", F.explode(F.sequence(F.col("_range") + 1, F.col("_range") + BACK)))
        .select("country", "event_date", "gross_revenue", "_range", F.lit(False).alias("_own"))
    )
    both = placed.withColumn("_own", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    series = W.partitionBy("country", "_range").orderBy("event_date")
    return _features(both, series).where("_own").drop("_own", "_range").na.drop()
