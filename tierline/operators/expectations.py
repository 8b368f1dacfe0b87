"""Data-quality rules declared as SQL predicates.

A list of rules is applied in one pass. Each row gets the name of the first rule it
breaks, which is the rule that would catch it if the rules ran one after the other.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.sources.counted import Counted

_log = logging.getLogger(__name__)

# What may be done about a broken rule.
ACTIONS = ("drop", "fail", "quarantine")

CAUGHT_BY = "_expectation"
_UNDECIDED = ""


class ExpectationFailed(ValueError):
    """A rule with action ``fail`` is broken."""


@dataclass(frozen=True)
class Expectation:
    """A named predicate and what to do with rows that break it.

    A predicate that gives NULL counts as broken. With ``null_is_violation=False`` such
    a row passes ``fail``, and is neither kept nor quarantined under the other actions.
    """

    name: str
    predicate: str
    action: str = "drop"
    null_is_violation: bool = True

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(
                f"expectation {self.name!r}: unknown action {self.action!r}, "
                f"use one of {', '.join(ACTIONS)}"
            )
        if not self.name:
            raise ValueError("an expectation needs a name")

    @property
    def broken(self) -> Column:
        """True for a violation; never NULL."""
        return ~F.coalesce(F.expr(self.predicate), F.lit(not self.null_is_violation))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(kept, quarantined or None). ``fail`` counts violations at once, with a job."""
        tagged = tag(df, [self])
        if self.action == "fail":
            check_failures(violation_counts(tagged, [self]), [self])
            return df, None
        if self.action == "quarantine":
            return kept(tagged), quarantined(tagged, [self])
        return kept(tagged), None

    def apply(self, df: DataFrame) -> DataFrame:
        """The kept rows alone."""
        return self.split(df)[0]


def tag(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Add ``_expectation``: the first rule a row breaks, NULL where it breaks none."""
    caught = F.lit(None).cast("string")
    for rule in reversed(rules):
        if rule.action != "fail" and not rule.null_is_violation:
            undecided = F.expr(rule.predicate).isNull()
            caught = F.when(undecided, F.lit(_UNDECIDED)).otherwise(caught)
        caught = F.when(rule.broken, F.lit(rule.name)).otherwise(caught)
    return df.withColumn(CAUGHT_BY, caught)


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(CAUGHT_BY).isNull()).drop(CAUGHT_BY)


def quarantined(tagged: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows caught by quarantine rules, with the rule and the time."""
    names = [r.name for r in rules if r.action == "quarantine"]
    return tagged.filter(F.col(CAUGHT_BY).isin(names)).withColumn(
        "_rejected_at", F.current_timestamp()
    )


def _counters(rules: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(F.col(CAUGHT_BY) == r.name).alias(r.name) for r in rules]


def violation_counts(tagged: DataFrame, rules: Sequence[Expectation]) -> dict[str, int]:
    """Rows caught by each rule; one job, one result row."""
    return tagged.agg(*_counters(rules)).first().asDict()


def counting(tagged: DataFrame, rules: Sequence[Expectation]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``tagged``, to be written once, and a function that then gives the rows caught by each rule.

    The job that writes the rows counts them, so there is no pass for the counts.
    """
    figures = {f"rule_{i}": F.count_if(F.col(CAUGHT_BY) == r.name) for i, r in enumerate(rules)}
    count = Counted(**figures)

    def caught() -> dict[str, int]:
        found = count.figures()
        return {r.name: found.get(f"rule_{i}", 0) for i, r in enumerate(rules)}

    return count.on(tagged), caught


def violations(tagged: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """``violation_counts`` as rows ``(expectation, rows)``, zero included."""
    pairs = [c for r in rules for c in (F.lit(r.name), F.col(f"`{r.name}`"))]
    return tagged.agg(*_counters(rules)).select(
        F.stack(F.lit(len(rules)), *pairs).alias("expectation", "rows")
    )


def check_failures(counts: dict[str, int], rules: Sequence[Expectation]) -> None:
    """Raise for a broken ``fail`` rule; log what ``drop`` rules removed."""
    for rule in rules:
        found = counts.get(rule.name) or 0
        if rule.action == "fail" and found:
            raise ExpectationFailed(
                f"expectation {rule.name!r} failed on {found} rows: {rule.predicate}"
            )
        if rule.action == "drop" and found:
            _log.info("expectation %s dropped %d rows", rule.name, found)


# The rules for Silver transactions.
SILVER_RULES = (
    Expectation("non_null_id", "transaction_id IS NOT NULL", "fail"),
    Expectation("positive_qty", "quantity > 0", "quarantine"),
    Expectation("non_negative_price", "unit_price >= 0", "quarantine"),
    Expectation("real_ts", "event_ts IS NOT NULL", "quarantine"),
)
