"""Marts after deliveries, corrections and replaced batches equal marts built anew."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierline.operators import mart_state, marts
from tierline.plans import increments, jobs
from tierline.schemas import RAW_TRANSACTIONS, SILVER_PARTITION
from tierline.sources import append_table, snapshot_table, upkeep

SALES = "transaction_id STRING, customer_id STRING, country STRING, revenue DOUBLE, event_ts TIMESTAMP, event_date DATE"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def sale(i, customer, country, amount, day, hour=9):
    at = datetime(2031, 5, day, hour)
    return (f"N-{i}", customer, country, amount, at, at.date())


def sales(spark, rows):
    return spark.createDataFrame(rows, SALES)


def check(spark, layout):
    silver = snapshot_table.read(spark, layout.silver)
    daily, ltv = (snapshot_table.read(spark, t) for t in (layout.daily_revenue, layout.customer_ltv))
    assert rows_of(daily) == rows_of(marts.daily_revenue(silver))
    assert rows_of(ltv) == rows_of(marts.customer_ltv(silver))
    assert snapshot_table.rows(spark, layout.customer_ltv) == ltv.count()


@pytest.mark.parametrize("divided", [SILVER_PARTITION, "month(event_date)"])
def test_marts_follow_random_changes(spark, layout, divided):
    rng = random.Random(4)
    state = {}
    for step in range(3):
        for _ in range(15 if step else 40):
            i = rng.randint(0, 60)
            customer = rng.choice(["K-1", "K-2", "K-3", "K-4", "K-5", None])
            amount = rng.choice([0.1, 0.2, 19.99, 1e-9, None, 1234567.891])
            day = rng.randint(1, 9)
            at = datetime(2031, rng.choice([5, 5, 6]), day, rng.randint(0, 23))
            state[i] = (f"N-{i}", customer, rng.choice(["ch", "li"]), amount, at, at.date())
        for i in rng.sample(sorted(state), 6 if step else 0):
            del state[i]
        rows = sales(spark, list(state.values()))
        if step == 0:
            snapshot_table.overwrite(rows, layout.silver, (divided,))
        else:
            snapshot_table.merge(rows, layout.silver, ["transaction_id"], update_if="s.event_ts <> t.event_ts OR NOT s.revenue <=> t.revenue", delete_unmatched_if="true")
        done = jobs.gold_job(spark, layout)
        assert done.how == (increments.INCREMENT if step else increments.REBUILD)
        check(spark, layout)
    assert jobs.gold_job(spark, layout) == increments.Refreshed(increments.CURRENT, 0)
    assert jobs.gold_job(spark, layout, full=True).how == increments.REBUILD
    check(spark, layout)


def test_only_changed_days_are_read(spark, layout, monkeypatch):
    rows = [sale(i, f"K-{i % 3}", "ch", 1.0, 1 + i % 5) for i in range(20)]
    snapshot_table.overwrite(sales(spark, rows), layout.silver, (SILVER_PARTITION,))
    jobs.gold_job(spark, layout)
    read = []
    inner = snapshot_table.read_folders

    def watched(spark, table, snap, folders=None):
        if table == layout.silver:
            read.append(sorted(snap.folders if folders is None else folders))
        return inner(spark, table, snap, folders)

    snapshot_table.upsert(sales(spark, [sale(100, "K-9", "li", 5.0, 3), sale(101, "K-1", "ch", 5.0, 7)]), layout.silver, ["transaction_id"])
    monkeypatch.setattr(snapshot_table, "read_folders", watched)
    assert jobs.gold_job(spark, layout) == increments.Refreshed(increments.INCREMENT, 2)
    assert read == [["event_date=2031-05-03", "event_date=2031-05-07"]]
    check(spark, layout)


def test_upkeep_is_no_change(spark, layout):
    rows = [sale(i, "K-1", "ch", 1.0, 1 + i % 2) for i in range(8)]
    snapshot_table.overwrite(sales(spark, rows), layout.silver, (SILVER_PARTITION,))
    jobs.gold_job(spark, layout)
    upkeep.optimize(spark, layout.silver, cluster_by="customer_id")
    assert jobs.gold_job(spark, layout) == increments.Refreshed(increments.INCREMENT, 0)
    check(spark, layout)


def test_a_run_cut_off_is_made_good(spark, layout, monkeypatch):
    snapshot_table.overwrite(sales(spark, [sale(1, "K-1", "ch", 1.0, 1)]), layout.silver, (SILVER_PARTITION,))
    jobs.gold_job(spark, layout)
    snapshot_table.upsert(sales(spark, [sale(2, "K-1", "ch", 2.0, 2)]), layout.silver, ["transaction_id"])
    with monkeypatch.context() as m:
        m.setattr(increments, "_write_ltv", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError, match="cut off"):
            jobs.gold_job(spark, layout)
    assert jobs.gold_job(spark, layout).how == increments.REBUILD
    check(spark, layout)


def test_versions_that_are_gone_mean_a_rebuild(spark, layout):
    snapshot_table.overwrite(sales(spark, [sale(1, "K-1", "ch", 1.0, 1)]), layout.silver, (SILVER_PARTITION,))
    jobs.gold_job(spark, layout)
    for i in (2, 3):
        snapshot_table.upsert(sales(spark, [sale(i, "K-1", "ch", 2.0, i)]), layout.silver, ["transaction_id"])
    upkeep.vacuum(spark, layout.silver, retain_hours=0, force=True)
    assert jobs.gold_job(spark, layout).how == increments.REBUILD
    check(spark, layout)


def test_amounts_too_large_for_the_state(spark, layout):
    snapshot_table.overwrite(sales(spark, [sale(1, "K-1", "ch", 1.0, 1)]), layout.silver, (SILVER_PARTITION,))
    jobs.gold_job(spark, layout)
    snapshot_table.upsert(sales(spark, [sale(2, "K-1", "ch", 1e25, 2)]), layout.silver, ["transaction_id"])
    for _ in range(2):
        assert jobs.gold_job(spark, layout).how == increments.DIRECT
        check(spark, layout)


def test_first_and_last_purchase_that_went(spark):
    days = mart_state.customer_days(sales(spark, [sale(1, "K-1", "ch", 1.0, 1), sale(2, "K-1", "ch", 2.0, 5), sale(3, "K-2", "ch", 3.0, 1), sale(4, "K-3", "li", 4.0, 4)]))
    gone = days.where("event_date = '2031-05-01'")
    none = days.where("false")
    moved = mart_state.moved_totals(mart_state.customer_totals(days), mart_state.customer_totals(gone), mart_state.customer_totals(none))
    got = {r["customer_id"]: (r["sales"], r["_lost"]) for r in moved.collect()}
    assert got == {"K-1": (1, True), "K-3": (1, False)}
    assert days.select("event_month").distinct().collect()[0][0] == "2031-05"
    assert {r["event_date"] for r in gone.collect()} == {date(2031, 5, 1)}


def test_three_deliveries_through_the_jobs(spark, layout):
    def raw(*rows):
        return spark.createDataFrame([(k, c, "P", str(q), "1.25", "CHF", t, "ch") for k, c, q, t in rows], RAW_TRANSACTIONS)

    append_table.append(raw(("N-1", "K-1", 1, "2031-05-01 08:00:00"), ("N-2", "K-2", 2, "2031-05-02 08:00:00")), layout.bronze, "a")
    append_table.append(raw(("N-3", "K-1", 3, "2031-05-03 08:00:00")), layout.bronze, "b")
    ways = []
    for step in (None, raw(("N-3", "K-2", 4, "2031-05-04 08:00:00")), raw(("N-2", "K-2", 9, "2031-05-09 08:00:00"))):
        if step is not None:
            append_table.append(step, layout.bronze, "a" if len(ways) == 2 else "c")
        jobs.silver_job(spark, layout)
        ways.append(jobs.gold_job(spark, layout).how)
        check(spark, layout)
    assert ways == [increments.REBUILD, increments.INCREMENT, increments.INCREMENT]
    assert {r["customer_id"]: r["orders"] for r in spark.table("gold_customer_ltv").collect()} == {"K-2": 2}
    assert spark.table("gold_daily_revenue").agg(F.sum("gross_revenue")).first()[0] == 13 * 1.25


def test_days_are_told_without_a_shuffle(spark):
    """The days that changed are names of folders: neither the state nor the daily mart is shuffled to find them."""
    days = [date(2031, 5, 1), date(2031, 5, 2), date(2031, 6, 1), None]
    rows = spark.createDataFrame([(d,) for d in days], "event_date DATE")

    def on(names, pattern="yyyy-MM-dd"):
        met = mart_state.on_days(names, pattern)
        found, rest = rows.where(met), rows.where(~met)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, (r[0] for r in found.union(rest).collect()))) == sorted(map(str, days))
        return {r[0] for r in found.collect()}

    assert on(["2031-05-02", None]) == {days[1], None}
    assert on(["2031-05-02"]) == {days[1]}
    assert on(["2031-05"], "yyyy-MM") == set(days[:2])
    assert on([None]) == {None} and on([]) == set()
