"""Sums of money held as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Micro-units: finer than any currency, and wide enough for 1e22 per row.
MONEY_TYPE = "decimal(28,6)"
# For what lies below micro-units, and for amounts from 1e22 up.
FINE_TYPE = "decimal(38,24)"
LARGE_TYPE = "decimal(38,0)"
# A remainder below this share of its amount is noise of binary fractions.
NOISE = 1e-14
# Of the sums that are kept: micro-units. The others keep their scale.
SUM_TYPE = "decimal(38,6)"


def _parts(c: Column) -> dict[str, Column]:
    exact = c.try_cast(MONEY_TYPE)
    rest = c - exact.cast("double")
    fine = F.when(F.abs(rest) > F.abs(c) * NOISE, rest).try_cast(FINE_TYPE)
    large = F.when(exact.isNull(), c).try_cast(LARGE_TYPE)
    return {"exact": exact, "fine": fine, "large": large, "huge": F.when(exact.isNull() & large.isNull(), c)}


def _total(exact: Column, fine: Column, large: Column, huge: Column) -> Column:
    parts = [exact.cast("double"), fine.cast("double"), large.cast("double"), huge]
    some = F.coalesce(*parts)
    return F.when(some.isNotNull(), sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)))


def money_sum(c: Column) -> Column:
    """Sum that does not depend on row order, partitioning or task retries.

    Double addition is not associative, so a shuffled sum changes in its last
    digits from run to run. Amounts are added as decimals instead: in micro-units, their
    remainders in finer units, and amounts from 1e22 in whole units. From 1e38, and where
    whole units overflow in sum, doubles are added, whose last digits may depend on order.
    """
    p = _parts(c)
    large = F.coalesce(F.try_sum(p["large"]).cast("double"), F.sum(p["large"].cast("double")))
    return _total(F.sum(p["exact"]), F.sum(p["fine"]), large, F.sum(p["huge"]))


def money_state(c: Column) -> dict[str, Column]:
    """Aggregates that, kept as columns, can be added to those of other rows, and taken away again.

    ``money_of`` gives the sum: the same as ``money_sum`` over all rows, as long as no amount reaches 1e22. The
    number of larger ones is kept in ``beyond``; a group that has some must be added up from its rows.
    """
    p = _parts(c)
    return {
        "exact": F.coalesce(F.sum(p["exact"]), F.lit(0)).cast(SUM_TYPE),
        "fine": F.coalesce(F.sum(p["fine"]), F.lit(0)).cast(FINE_TYPE),
        "amounts": F.count(p["exact"]),
        "beyond": F.count(c) - F.count(p["exact"]),
    }


def money_of(exact: Column, fine: Column, amounts: Column) -> Column:
    """The sum that a state stands for, NULL where no amount was added."""
    return F.when(amounts > 0, exact.cast("double") + fine.cast("double"))
