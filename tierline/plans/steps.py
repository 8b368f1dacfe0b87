"""Tables declared by the query that fills them and the checks its rows must stand."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tierline.operators import clean, expectations, marts
from tierline.operators.expectations import Expectation
from tierline.plans.jobs import read_bronze
from tierline.sources import append_table, snapshot_table
from tierline.sources.layout import Layout
from tierline.sources.scratch import staged


class Checks(NamedTuple):
    """Rules in order, and the append table that takes what they quarantine."""

    rules: tuple[Expectation, ...]
    rejects: str


class Step(NamedTuple):
    """``query`` gives the rows of the table ``into``; ``checks`` may hold some of them back."""

    into: str
    query: Callable[[SparkSession], DataFrame]
    checks: Checks | None = None
    folders: tuple[str, ...] = ()


class Built(NamedTuple):
    """The version a step wrote, its rows, and the rows each rule caught."""

    version: int
    rows: int
    caught: dict[str, int]


def build(spark: SparkSession, name: str, step: Step, delivery: str | None = None) -> Built:
    """Fill the step's table as a new version and append what its checks hold back.

    The tagged rows are written once to the shared folder, by a job that counts what every rule caught;
    kept rows and rejects are read from there. A broken ``fail`` rule raises before anything is
    written to the step's tables. Rejects of the same ``delivery`` replace the earlier ones.
    """
    if step.checks is None:
        version = snapshot_table.overwrite(step.query(spark), step.into, step.folders, name)
        return Built(version, snapshot_table.rows(spark, step.into, version), {})
    rules, rejects = step.checks
    tagged, caught = expectations.counting(expectations.tag(step.query(spark), rules), rules)
    with staged(tagged, "tagged") as rows:
        counts = caught()
        expectations.check_failures(counts, rules)
        version = snapshot_table.overwrite(expectations.kept(rows), step.into, step.folders, name)
        if any(r.action == "quarantine" for r in rules):
            append_table.append(expectations.quarantined(rows, rules), rejects, delivery)
            append_table.drop_replaced(spark, rejects)
    return Built(version, snapshot_table.rows(spark, step.into, version), counts)


def retail_steps(layout: Layout, as_of: int | None = None) -> dict[str, Step]:
    """Silver under the declared rules, then the narrow daily mart, in this order."""
    return {
        "silver_transactions": Step(
            layout.silver,
            lambda spark: clean.silver_before_rules(read_bronze(spark, layout, as_of=as_of)),
            Checks(expectations.SILVER_RULES, layout.rejects),
            (layout.silver_by,),
        ),
        "gold_daily_revenue": Step(
            layout.daily_narrow,
            lambda spark: marts.daily_narrow(snapshot_table.read(spark, layout.silver)),
        ),
    }


def declared_builds(spark: SparkSession, layout: Layout) -> dict[str, Built]:
    """Build every step, in order, from the newest Bronze version.

    Rejects are keyed by the Bronze version read: running again over the same Bronze
    replaces them.
    """
    upto = append_table.latest_version(spark, layout.bronze)
    if upto is None:
        raise FileNotFoundError(f"nothing ingested at {layout.bronze}")
    steps = retail_steps(layout, as_of=upto)
    return {name: build(spark, name, step, f"declared-{upto}") for name, step in steps.items()}


def declarative_job(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """``declared_builds``; returns the version written by each step."""
    return {name: built.version for name, built in declared_builds(spark, layout).items()}
