"""Merges by key, counts kept by the writes, and batches that are replaced."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tierline.plans import jobs
from tierline.schemas import RAW_TRANSACTIONS
from tierline.sources import append_table, counted, files, snapshot_table
from tierline.sources.layout import Layout

SCHEMA = "k STRING, v INT, day DATE"
DAYS = [date(2031, 5, d) for d in range(1, 6)] + [date(2031, 6, d) for d in range(1, 4)]


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, SCHEMA + extra)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def expected(table, source, unmatched):
    """The rules of the test below, one row after the other."""
    state, counts = dict(table), {"inserted": 0, "updated": 0, "deleted": 0}
    for k, v, day, what in source:
        if k in table:
            if what == "drop":
                del state[k]
                counts["deleted"] += 1
            elif v > table[k][1]:
                state[k] = (k, v, day)
                counts["updated"] += 1
        elif what != "drop":
            state[k] = (k, v, day)
            counts["inserted"] += 1
    for k in [k for k, row in table.items() if k not in {s[0] for s in source} and row[1] < unmatched]:
        del state[k]
        counts["deleted"] += 1
    return state, counts


@pytest.mark.parametrize("divided", [("day",), ("month(day)",), ()])
def test_merge_against_a_dictionary(spark, table, divided):
    rng = random.Random(21)
    state = {f"k{i}": (f"k{i}", rng.randint(0, 50), rng.choice(DAYS)) for i in range(30)}
    snapshot_table.overwrite(frame(spark, list(state.values())), table, divided)
    for unmatched in (0, 9):
        source = [
            (k, rng.randint(0, 50), rng.choice(DAYS + [None]), rng.choice(["drop", "put", "put", None]))
            for k in rng.sample([f"k{i}" for i in range(45)], 12)
        ]
        state, counts = expected(state, source, unmatched)
        done = snapshot_table.merge(
            frame(spark, source, ", _merge_what STRING"),
            table,
            ["k"],
            update_if="s.v > t.v",
            insert_if="s._merge_what IS NULL OR s._merge_what <> 'drop'",
            delete_if="s._merge_what = 'drop'",
            delete_unmatched_if=f"t.v < {unmatched}" if unmatched else "false",
        )
        assert rows_of(snapshot_table.read(spark, table)) == sorted(state.values(), key=str)
        assert {k: getattr(done, k) for k in counts} == counts
        assert snapshot_table.rows(spark, table) == len(state)
    assert snapshot_table.read(spark, table).columns == ["k", "v", "day"]


def test_a_merge_that_changes_nothing_writes_nothing(spark, table):
    snapshot_table.overwrite(frame(spark, [("a", 5, DAYS[0])]), table, ("day",), source_version=1)
    source = frame(spark, [("a", 4, DAYS[1]), ("b", 9, DAYS[2])])
    done = snapshot_table.merge(source, table, ["k"], update_if="s.v > t.v", insert_if="s.v < 0")
    assert done == snapshot_table.Merged(0, 0, 0, 0) and snapshot_table.versions(spark, table) == [0]
    # What it was made from is still remembered.
    done = snapshot_table.merge(source, table, ["k"], update_if="s.v > t.v", insert_if="s.v < 0", source_version=2)
    snap = snapshot_table.snapshot(spark, table)
    assert done.version == 1 and snap.source_version == 2 and snap.folders == {f"day={DAYS[0]}": 0}
    assert snapshot_table.rows(spark, table) == 1


def test_only_partitions_with_a_change_are_written(spark, table):
    snapshot_table.overwrite(frame(spark, [("a", 1, DAYS[0]), ("b", 5, DAYS[1]), ("c", 1, DAYS[2])]), table, ("day",))
    # The copy of b is the lesser one: its day is left as it is, and b is not added a second time.
    source = frame(spark, [("a", 2, DAYS[0]), ("b", 4, DAYS[3])])
    assert snapshot_table.merge(source, table, ["k"], update_if="s.v > t.v")[1:] == (0, 1, 0)
    assert snapshot_table.snapshot(spark, table).folders == {f"day={DAYS[0]}": 1, f"day={DAYS[1]}": 0, f"day={DAYS[2]}": 0}
    assert rows_of(snapshot_table.read(spark, table)) == [("a", 2, DAYS[0]), ("b", 5, DAYS[1]), ("c", 1, DAYS[2])]


def test_keys_that_match_twice_are_refused(spark, table):
    snapshot_table.overwrite(frame(spark, [("a", 1, DAYS[0]), ("a", 2, DAYS[1])]), table, ("day",))
    with pytest.raises(snapshot_table.DuplicateSourceKeys):
        snapshot_table.merge(frame(spark, [("a", 3, DAYS[0])]), table, ["k"])
    assert snapshot_table.versions(spark, table) == [0]


def test_columns_with_odd_names(spark, table):
    df = spark.createDataFrame([("x", 1, "p")], "`a.b` STRING, s INT, t STRING").withColumnRenamed("a.b", "k")
    snapshot_table.overwrite(df, table, ("t",))
    done = snapshot_table.merge(spark.createDataFrame([("x", 2, "q")], "k STRING, s INT, t STRING"), table, ["k"])
    assert done.updated == 1 and rows_of(snapshot_table.read(spark, table)) == [("x", 2, "q")]


# ---- counts -------------------------------------------------------------------------


def test_counts_come_from_the_write(spark, table, monkeypatch):
    append_table.append(spark.range(7), table, "a")
    append_table.append(spark.range(0), table, "b")
    append_table.append(spark.range(4), table, "a")
    assert sorted(append_table.counts(spark, table).values()) == [0, 4] and append_table.rows(spark, table) == 4
    assert append_table.rows(spark, table + "-none") is None
    assert sorted(counted.marked(spark, f"{table}/ingest_version=*/batch_key=*").values()) == [0, 4, 7]
    # A batch without a count is read, and only that one.
    path = append_table.committed(spark, table)[-1].path
    files.delete(spark, f"{path}/_rows-4")
    read = []
    inner = append_table.read_batches
    monkeypatch.setattr(append_table, "read_batches", lambda s, t, done, *a: read.extend(done) or inner(s, t, done, *a))
    assert append_table.rows(spark, table) == 4 and [a.path for a in read] == [path]


def test_counts_of_shuffled_and_partitioned_writes(spark, table):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"), F.date_add(F.lit(DAYS[0]), (F.col("id") % 9).cast("int")).alias("day"))
    snapshot_table.overwrite(df, table, ("day",))
    assert snapshot_table.rows(spark, table) == 1000
    snapshot_table.upsert(frame(spark, [("k1", 2, DAYS[1]), ("new", 1, None)]), table, ["k"])
    assert snapshot_table.rows(spark, table) == 1001 == snapshot_table.read(spark, table).count()
    assert snapshot_table.rows(spark, table, 0) == 1000


# ---- replaced batches ---------------------------------------------------------------


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_TRANSACTIONS)


def sale(key, quantity, time, customer="K-1"):
    return (key, customer, "P-7", str(quantity), "2.50", "CHF", time, "ch")


def test_a_replaced_batch_takes_its_rows_along(spark, tmp_path):
    """Of a batch delivered again with fewer rows, the missing ones go, or give way to the next best copy."""
    first = [sale("N-1", 1, "2031-05-01 08:00:00"), sale("N-2", 1, "2031-05-02 08:00:00"), sale("N-3", 1, "2031-05-03 08:00:00")]
    second = [sale("N-2", 8, "2031-05-06 09:00:00"), sale("N-4", 4, "2031-05-04 08:00:00"), sale("N-5", 5, "2031-05-05 08:00:00"), sale("", 1, "")]
    again = [sale("N-5", 9, "2031-05-01 08:00:00")]
    results = []
    for full in (False, True):
        layout = Layout(str(tmp_path / f"full-{full}"))
        append_table.append(raw(spark, first), layout.bronze, "one")
        append_table.append(raw(spark, second), layout.bronze, "two")
        counts = jobs.silver_job(spark, layout, full)
        assert counts["silver"] == 5 and counts["bronze"] == 7
        append_table.append(raw(spark, again), layout.bronze, "two")
        assert len(append_table.replaced(spark, layout.bronze)) == 1
        counts = jobs.silver_job(spark, layout, full)
        assert counts["silver"] == 4 and counts["bronze"] == 4
        assert append_table.replaced(spark, layout.bronze) == []
        silver = snapshot_table.read(spark, layout.silver)
        assert silver.count() == 4
        results.append(rows_of(silver.select("transaction_id", "quantity", "event_date")))
    # N-2 is the copy of the first batch again, N-4 is gone, N-5 is the earlier time of the new batch.
    assert results[0] == results[1] == [
        ("N-1", 1, date(2031, 5, 1)), ("N-2", 1, date(2031, 5, 2)), ("N-3", 1, date(2031, 5, 3)), ("N-5", 9, date(2031, 5, 1)),
    ]


def test_a_batch_replaced_before_silver_saw_it(spark, layout):
    append_table.append(raw(spark, [sale("N-1", 1, "2031-05-01 08:00:00"), sale("N-2", 1, "2031-05-02 08:00:00")]), layout.bronze, "b")
    append_table.append(raw(spark, [sale("N-1", 3, "2031-05-01 08:00:00")]), layout.bronze, "b")
    assert jobs.silver_job(spark, layout)["silver"] == 1
    append_table.append(raw(spark, []), layout.bronze, "b")
    assert jobs.silver_job(spark, layout)["silver"] == 0
    assert snapshot_table.read(spark, layout.silver).count() == 0


def test_changes_of_a_replaced_batch_come_from_one_scan(spark, layout):
    """Bronze and the replaced batch are read once each, not once for every kind of change."""
    first = [sale("N-1", 1, "2031-05-01 08:00:00"), sale("N-2", 1, "2031-05-02 08:00:00")]
    second = [sale("N-2", 8, "2031-05-06 09:00:00"), sale("N-4", 4, "2031-05-04 08:00:00"), sale("N-7", 0, "2031-05-04 08:00:00")]
    again = [sale("N-7", 7, "2031-05-04 08:00:00"), sale("N-7", 6, "2031-05-03 08:00:00")]
    third = [sale("N-1", 3, "2031-04-01 08:00:00"), sale("N-4", 0, "2031-05-04 08:00:00"), sale("N-8", 8, "2031-05-08 08:00:00")]
    for key, rows in (("one", first), ("two", second), ("two", again), ("three", third)):
        append_table.append(raw(spark, rows), layout.bronze, key)
    changes = jobs.silver_changes(spark, layout, seen=1, upto=3)
    assert rows_of(changes.select("transaction_id", "quantity", "_merge_change")) == [
        ("N-1", 3, "competes"), ("N-2", 1, "judged"), ("N-4", None, "gone"), ("N-7", 7, "judged"), ("N-8", 8, "competes"),
    ]
    # The keys are read a second time for those that have no copy left.
    assert changes._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 3


def test_a_run_cut_off_before_the_old_batch_was_dropped(spark, layout, monkeypatch):
    append_table.append(raw(spark, [sale("N-1", 1, "2031-05-01 08:00:00"), sale("N-2", 1, "2031-05-02 08:00:00")]), layout.bronze, "b")
    jobs.silver_job(spark, layout)
    append_table.append(raw(spark, [sale("N-2", 2, "2031-05-02 08:00:00")]), layout.bronze, "b")
    with monkeypatch.context() as m:
        m.setattr(append_table, "drop_replaced", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError, match="cut off"):
            jobs.silver_job(spark, layout)
    append_table.append(raw(spark, [sale("N-6", 6, "2031-05-07 08:00:00")]), layout.bronze, "c")
    assert jobs.silver_job(spark, layout)["silver"] == 2
    assert rows_of(snapshot_table.read(spark, layout.silver).select("transaction_id", "quantity")) == [("N-2", 2), ("N-6", 6)]


def test_bronze_job_names_a_delivery(spark, layout, write_raw):
    path = write_raw([sale("N-1", 1, "2031-05-01 08:00:00"), sale("N-2", 1, "2031-05-02 08:00:00")])
    assert jobs.bronze_job(spark, layout, path, batch_key="may") == 2
    write_raw([sale("N-1", 1, "2031-05-01 08:00:00")])
    assert jobs.bronze_job(spark, layout, path, batch_key="may") == 1
    assert jobs.bronze_job(spark, layout, path) == 2


def test_only_keys_and_places_are_joined_for_the_decision(spark, table, monkeypatch):
    snapshot_table.overwrite(frame(spark, [(f"k{i}", i, DAYS[i % 8]) for i in range(40)]), table, ("month(day)",))
    decided, inner = [], snapshot_table.staged
    monkeypatch.setattr(snapshot_table, "staged", lambda df, *a: decided.append(df) or inner(df, *a))
    done = snapshot_table.merge(frame(spark, [("k1", 7, DAYS[1]), ("new", 8, DAYS[0])]), table, ["k"])
    assert done[1:] == (1, 1, 0)
    plan = decided[0]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string,day:date>" in plan and "v:int" not in plan


def test_folders_that_only_gain_rows_are_not_joined(spark, table, monkeypatch):
    rows = [(f"k{i}", i, DAYS[i % 8]) for i in range(40)]
    snapshot_table.overwrite(frame(spark, rows), table, ("day",))
    written, inner = [], snapshot_table.replace_folders
    monkeypatch.setattr(snapshot_table, "replace_folders", lambda df, *a, **k: written.append(df._jdf.queryExecution().optimizedPlan().toString()) or inner(df, *a, **k))
    new = [("n1", 1, DAYS[0]), ("n2", 2, DAYS[0]), (None, 3, DAYS[2]), (None, 4, DAYS[2])]
    assert snapshot_table.merge(frame(spark, new), table, ["k"])[1:] == (4, 0, 0)
    assert "Join" not in written[0]
    assert rows_of(snapshot_table.read(spark, table)) == sorted([*rows, *new], key=str)
    # One row changes its day: the folder it leaves is joined, the one it comes to is not.
    assert snapshot_table.merge(frame(spark, [("k5", 50, DAYS[6])]), table, ["k"])[1:] == (0, 1, 0)
    assert written[1].count("Join") == 1 and "Union" in written[1]
    left = [r for r in rows if r[0] != "k5"]
    assert rows_of(snapshot_table.read(spark, table)) == sorted([*left, *new, ("k5", 50, DAYS[6])], key=str)
    assert snapshot_table.rows(spark, table) == 44
