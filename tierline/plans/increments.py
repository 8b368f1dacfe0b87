"""Marts that follow Silver: only the days that changed are read again."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import mart_state, marts
from tierline.schemas import SILVER_PARTITION
from tierline.sources import snapshot_table
from tierline.sources.counted import Counted
from tierline.sources.layout import Layout
from tierline.sources.scratch import staged

REBUILD, INCREMENT, CURRENT, DIRECT = "rebuild", "increment", "current", "direct"


class Refreshed(NamedTuple):
    """How the marts came up to date, and how many folders (days) of Silver were read for it (None: all)."""

    how: str
    folders: int | None


# How Silver may be divided, and what its folder names look like.
_PATTERNS = {(SILVER_PARTITION,): "yyyy-MM-dd", (f"month({SILVER_PARTITION})",): "yyyy-MM"}


def refresh(spark: SparkSession, layout: Layout, full: bool = False) -> Refreshed:
    """Bring marts and their state to the newest version of Silver.

    The marts and the state remember the version of Silver they show. If all show the same one, the days
    changed since are read, else all of Silver. A run cut off in between leaves them at different versions,
    so the next one starts anew.
    """
    silver = snapshot_table.snapshot(spark, layout.silver)
    tables = (layout.customer_days, layout.customer_totals, layout.customer_ltv, layout.daily_revenue)
    shown = {
        snapshot_table.snapshot(spark, t).source_version if snapshot_table.latest_version(spark, t) is not None else None
        for t in tables
    }
    since = shown.pop() if len(shown) == 1 and not full else None
    if since == silver.version:
        return Refreshed(CURRENT, 0)
    changed = None
    if since is not None and silver.partition_by in _PATTERNS:
        changed = snapshot_table.changed_folders(spark, layout.silver, since)
    if changed is None:
        return _rebuild(spark, layout, silver)
    return _increment(spark, layout, silver, changed)


def _beyond() -> Counted:
    return Counted(beyond=F.sum("beyond"))


def _direct(spark: SparkSession, layout: Layout, silver: DataFrame) -> Refreshed:
    """From the sales themselves; no version is remembered, so the next run does not build on the state."""
    snapshot_table.overwrite(marts.by_day(marts.daily_revenue(silver)), layout.daily_revenue)
    snapshot_table.overwrite(marts.by_value(marts.customer_ltv(silver)), layout.customer_ltv)
    return Refreshed(DIRECT, None)


def _rebuild(spark: SparkSession, layout: Layout, snap: snapshot_table.Snapshot) -> Refreshed:
    silver, at = snapshot_table.read_folders(spark, layout.silver, snap), snap.version
    with staged(mart_state.customer_days(silver), "customer-days", _beyond()) as (days, found):
        if found.get("beyond"):
            return _direct(spark, layout, silver)
        snapshot_table.overwrite(days, layout.customer_days, (mart_state.MONTH,), REBUILD, at)
        snapshot_table.overwrite(mart_state.customer_totals(days), layout.customer_totals, (), REBUILD, at)
        _write_ltv(spark, layout, REBUILD, at)
        snapshot_table.overwrite(marts.by_day(mart_state.daily_of(days)), layout.daily_revenue, (), REBUILD, at)
    return Refreshed(REBUILD, None)


def _write_ltv(spark: SparkSession, layout: Layout, how: str, at: int) -> None:
    totals = snapshot_table.read(spark, layout.customer_totals)
    snapshot_table.overwrite(marts.by_value(mart_state.ltv_of(totals)), layout.customer_ltv, (), how, at)


def _day(folder: str) -> str | None:
    value = folder.split("=", 1)[1]
    return None if value == snapshot_table.NULL_PARTITION else value


def _increment(spark: SparkSession, layout: Layout, snap: snapshot_table.Snapshot, changed: list[str]) -> Refreshed:
    at, pattern = snap.version, _PATTERNS[snap.partition_by]
    dates = [_day(f) for f in changed]
    on_changed = mart_state.on_days(dates, pattern)
    sales = snapshot_table.read_folders(spark, layout.silver, snap, [f for f in changed if f in snap.folders])
    with staged(mart_state.customer_days(sales), "customer-days", _beyond()) as (new, found):
        if found.get("beyond"):
            return _direct(spark, layout, snapshot_table.read_folders(spark, layout.silver, snap))
        state = snapshot_table.snapshot(spark, layout.customer_days)
        months = {f"{mart_state.MONTH}={d[:7] if d else snapshot_table.NULL_PARTITION}" for d in dates}
        touched = [f for f in state.folders if f in months]
        before = snapshot_table.read_folders(spark, layout.customer_days, state, touched)
        kept, went = before.where(~on_changed), before.where(on_changed)
        snapshot_table.replace_folders(
            kept.unionByName(new), layout.customer_days, state, touched, INCREMENT, at, spread=True
        )
        totals = mart_state.moved_totals(
            snapshot_table.read(spark, layout.customer_totals),
            mart_state.customer_totals(went),
            mart_state.customer_totals(new),
        )
        with staged(totals, "totals", Counted(lost=F.count_if("_lost"))) as (moved, figures):
            settled = moved.where("NOT _lost").drop("_lost")
            if figures.get("lost"):
                lost = moved.where("_lost").select(F.col("customer_id").alias("_who"))
                theirs = snapshot_table.read(spark, layout.customer_days)
                theirs = theirs.join(lost, F.col("customer_id").eqNullSafe(F.col("_who")), "left_semi")
                settled = settled.unionByName(mart_state.customer_totals(theirs))
            snapshot_table.overwrite(settled, layout.customer_totals, (), INCREMENT, at)
        _write_ltv(spark, layout, INCREMENT, at)
        daily = snapshot_table.read(spark, layout.daily_revenue).where(~on_changed)
        daily = daily.unionByName(mart_state.daily_of(new))
        snapshot_table.overwrite(marts.by_day(daily), layout.daily_revenue, (), INCREMENT, at)
    return Refreshed(INCREMENT, len(changed))
