import random
from datetime import date, datetime, timedelta, timezone

import pytest
from conftest import ids
from pyspark.sql import functions as F

from tierline import schemas
from tierline.sources import append_table, files, snapshot_table, upkeep


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- append tables ------------------------------------------------------------------


def test_append_and_time_travel(spark, table):
    assert append_table.latest_version(spark, table) is None
    assert append_table.append(spark.createDataFrame([(1,)], "a INT"), table) == 0
    assert append_table.append(spark.createDataFrame([(2, "x")], "a INT, b STRING"), table) == 1
    now = append_table.read(spark, table)
    assert rows_of(now.select("a", "b")) == [(1, None), (2, "x")]
    old = append_table.read(spark, table, as_of=0)
    assert "b" not in old.columns and old.count() == 1
    assert ids(append_table.read(spark, table, after=0), "a") == {2}
    with pytest.raises(FileNotFoundError):
        append_table.read(spark, table, after=1)


def test_the_same_batch_replaces_itself(spark, table):
    append_table.append(spark.range(3), table, "b-0")
    append_table.append(spark.range(5), table, "b-1")
    assert append_table.append(spark.range(3), table, "b-0") == 2
    assert append_table.read(spark, table).count() == 8


def test_unfinished_append_is_not_read(spark, table):
    append_table.append(spark.range(3), table)
    spark.range(100).write.parquet(f"{table}/ingest_version=1/batch_key=broken")
    files.delete(spark, f"{table}/ingest_version=1/batch_key=broken/_SUCCESS")
    assert append_table.read(spark, table).count() == 3
    assert append_table.append(spark.range(2), table) == 2
    # The batch comes again: under a new version, and its remains are gone.
    assert append_table.append(spark.range(10), table, "broken") == 3
    assert append_table.read(spark, table).count() == 15
    assert not files.exists(spark, f"{table}/ingest_version=1/batch_key=broken")


def test_kept_batch(spark, table):
    append_table.append(spark.range(3), table, "b")
    assert append_table.append(spark.range(9), table, "b", keep=True) == 0
    assert append_table.read(spark, table).count() == 3


def test_evolution_can_be_refused(spark, table):
    append_table.append(spark.createDataFrame([(8.5, "jar")], "weight DOUBLE, kind STRING"), table)
    wider = spark.createDataFrame([(0.3, "tea", True)], "weight DOUBLE, kind STRING, loose BOOLEAN")
    with pytest.raises(schemas.SchemaMismatch, match="unknown column loose"):
        append_table.append(wider, table, evolve=False)
    assert append_table.append(wider.drop("loose"), table, evolve=False) == 1
    assert append_table.append(wider, table) == 2


def test_bad_batch_key(spark, table):
    with pytest.raises(ValueError):
        append_table.append(spark.range(1), table, "a/b")


# ---- snapshot tables ----------------------------------------------------------------

SCHEMA = "k STRING, v INT, day DATE"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_upsert_against_a_dictionary(spark, table):
    rng = random.Random(7)
    days = [date(2025, 1, d) for d in range(1, 7)]
    state = {}
    history = []
    for step in range(6):
        keys = rng.sample([f"k{i}" for i in range(20)], 8)
        batch = [(k, rng.randint(0, 99), rng.choice(days)) for k in keys]
        snapshot_table.write_or_upsert(frame(spark, batch), table, ["k"], ("day",))
        state.update({r[0]: r for r in batch})
        history.append(dict(state))
        assert rows_of(snapshot_table.read(spark, table)) == sorted(state.values(), key=str)
    for version, then in enumerate(history):
        assert rows_of(snapshot_table.read(spark, table, version)) == sorted(then.values(), key=str)


def test_upsert_rewrites_only_touched_partitions(spark, table):
    d = [date(2025, 1, i) for i in range(1, 5)]
    snapshot_table.overwrite(frame(spark, [("a", 1, d[0]), ("b", 1, d[1]), ("c", 1, d[2])]), table, ("day",))
    snapshot_table.upsert(frame(spark, [("a", 2, d[3])]), table, ["k"])
    snap = snapshot_table.snapshot(spark, table)
    # The row left day 1, which is gone, and moved to day 4; the others are shared.
    assert snap.folders == {"day=2025-01-02": 0, "day=2025-01-03": 0, "day=2025-01-04": 1}
    assert rows_of(snapshot_table.read(spark, table)) == sorted([("a", 2, d[3]), ("b", 1, d[1]), ("c", 1, d[2])], key=str)


def test_upsert_is_idempotent(spark, table):
    rows = frame(spark, [("a", 1, date(2025, 1, 1)), ("b", 2, date(2025, 1, 2))])
    for _ in range(3):
        snapshot_table.write_or_upsert(rows, table, ["k"], ("day",))
    assert snapshot_table.read(spark, table).count() == 2
    assert snapshot_table.versions(spark, table) == [0, 1, 2]


def test_null_keys_and_null_partitions(spark, table):
    snapshot_table.overwrite(frame(spark, [(None, 1, None), ("a", 1, None)]), table, ("day",))
    snapshot_table.upsert(frame(spark, [(None, 2, None), ("a", 5, date(2025, 1, 1))]), table, ["k"])
    assert rows_of(snapshot_table.read(spark, table)) == sorted(
        [(None, 1, None), (None, 2, None), ("a", 5, date(2025, 1, 1))], key=str
    )


def test_unpartitioned_upsert_and_odd_partition_values(spark, table):
    df = spark.createDataFrame([("a", "x/y z"), ("b", "50%=")], "k STRING, p STRING")
    snapshot_table.overwrite(df, table + "p", ("p",))
    snapshot_table.upsert(spark.createDataFrame([("a", "50%=")], "k STRING, p STRING"), table + "p", ["k"])
    assert rows_of(snapshot_table.read(spark, table + "p")) == [("a", "50%="), ("b", "50%=")]
    snapshot_table.overwrite(df, table)
    snapshot_table.upsert(spark.createDataFrame([("c", "q")], "k STRING, p STRING"), table, ["k"])
    assert snapshot_table.read(spark, table).count() == 3


def test_key_that_holds_the_partition_column(spark, table):
    rows = [("a", 1, date(2025, 1, 1)), ("a", 2, date(2025, 1, 2))]
    snapshot_table.overwrite(frame(spark, rows), table, ("day",))
    snapshot_table.upsert(frame(spark, [("a", 9, date(2025, 1, 2))]), table, ["k", "day"])
    assert rows_of(snapshot_table.read(spark, table).select("v")) == [(1,), (9,)]


def test_ambiguous_updates_are_refused(spark, table):
    d = date(2025, 1, 1)
    snapshot_table.overwrite(frame(spark, [("a", 1, d)]), table, ("day",))
    with pytest.raises(snapshot_table.DuplicateSourceKeys):
        snapshot_table.upsert(frame(spark, [("a", 2, d), ("a", 3, d)]), table, ["k"])
    # Copies that match nothing are inserted, both of them.
    snapshot_table.upsert(frame(spark, [("n", 2, d), ("n", 3, d)]), table, ["k"])
    assert snapshot_table.read(spark, table).count() == 3


def test_new_column_in_updates(spark, table):
    snapshot_table.overwrite(frame(spark, [("a", 1, date(2025, 1, 1)), ("b", 1, date(2025, 1, 2))]), table, ("day",))
    wider = frame(spark, [("b", 2, date(2025, 1, 2))]).withColumn("note", F.lit("n"))
    snapshot_table.upsert(wider, table, ["k"])
    got = {r["k"]: r["note"] for r in snapshot_table.read(spark, table).collect()}
    assert got == {"a": None, "b": "n"}
    assert "note" not in snapshot_table.read(spark, table, 0).columns


def test_overwrite_replaces_rows_and_schema(spark, table):
    snapshot_table.overwrite(spark.range(3), table)
    snapshot_table.overwrite(spark.createDataFrame([("x",)], "s STRING"), table)
    assert rows_of(snapshot_table.read(spark, table)) == [("x",)]
    assert snapshot_table.read(spark, table, 0).count() == 3
    with pytest.raises(FileNotFoundError):
        snapshot_table.read(spark, table, 5)


def test_empty_tables(spark, table):
    snapshot_table.overwrite(frame(spark, []), table, ("day",))
    assert snapshot_table.read(spark, table).count() == 0
    snapshot_table.upsert(frame(spark, [("a", 1, date(2025, 1, 1))]), table, ["k"])
    assert snapshot_table.read(spark, table).count() == 1


def test_failed_write_stays_invisible(spark, table):
    snapshot_table.overwrite(spark.range(3), table)
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        snapshot_table.overwrite(broken, table)
    assert snapshot_table.versions(spark, table) == [0]
    assert snapshot_table.read(spark, table).count() == 3
    assert snapshot_table.overwrite(spark.range(4), table) == 1
    assert snapshot_table.read(spark, table).count() == 4


def test_updates_that_do_not_fit_are_refused(spark, table):
    snapshot_table.overwrite(frame(spark, [("a", 1, date(2025, 1, 1))]), table, ("day",))
    with pytest.raises(schemas.SchemaMismatch, match="missing column v"):
        snapshot_table.upsert(frame(spark, []).drop("v"), table, ["k"])
    with pytest.raises(schemas.SchemaMismatch, match="unknown column note"):
        snapshot_table.upsert(frame(spark, []).withColumn("note", F.lit("n")), table, ["k"], evolve=False)
    assert snapshot_table.versions(spark, table) == [0]


def test_updates_may_lose_to_the_rows_they_match(spark, table):
    d = date(2025, 1, 1)
    snapshot_table.overwrite(frame(spark, [("a", 5, d), ("b", 5, d)]), table, ("day",))

    def highest(rows):
        return rows.groupBy("k").agg(F.max("v").alias("v"), F.max("day").alias("day"))

    snapshot_table.upsert(frame(spark, [("a", 3, d), ("b", 7, d)]), table, ["k"], resolve=highest)
    assert rows_of(snapshot_table.read(spark, table)) == [("a", 5, d), ("b", 7, d)]


# ---- upkeep -------------------------------------------------------------------------


def test_compaction_keeps_rows_and_merges_files(spark, table):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"), F.lit(date(2025, 1, 1)).alias("day"))
    snapshot_table.overwrite(df.repartition(12), table, ("day",), spread=False)
    assert upkeep.file_inventory(spark, table).count() == 12
    before = rows_of(snapshot_table.read(spark, table))
    assert upkeep.optimize(spark, table) == 1
    assert upkeep.file_inventory(spark, table).count() == 1
    assert rows_of(snapshot_table.read(spark, table)) == before
    assert upkeep.optimize(spark, table) is None


def test_clustering_cuts_a_hot_partition_and_a_hot_customer(spark, table):
    df = spark.range(20000).select(
        F.concat(F.lit("T"), "id").alias("k"),
        F.when(F.col("id") % 3 == 0, "C-hot").otherwise(F.concat(F.lit("C-"), F.col("id") % 100)).alias("customer_id"),
        F.lit(date(2025, 1, 1)).alias("day"),
    )
    snapshot_table.overwrite(df, table, ("day",))
    size = upkeep.file_inventory(spark, table).agg(F.sum("bytes")).first()[0]
    upkeep.optimize(spark, table, cluster_by="customer_id", target_bytes=size // 6)
    now = snapshot_table.read(spark, table)
    per_file = [
        r["n"]
        for r in now.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()
    ]
    assert sum(per_file) == 20000 and len(per_file) >= 6
    assert max(per_file) < 20000 / 3
    ranges = now.groupBy(F.input_file_name().alias("f")).agg(F.min("customer_id").alias("lo"), F.max("customer_id").alias("hi"))
    spans = sorted((r["lo"], r["hi"]) for r in ranges.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_upkeep_leaves_untouched_days_alone(spark, table):
    days = [date(2025, 1, i) for i in (1, 2, 3)]
    rows = [(f"k{i}", i, d) for i, d in enumerate(days)]
    snapshot_table.overwrite(frame(spark, rows), table, ("day",))
    assert upkeep.optimize(spark, table, cluster_by="k") == 1
    assert upkeep.optimize(spark, table, cluster_by="k") is None
    assert upkeep.optimize(spark, table) is None
    snapshot_table.upsert(frame(spark, [("k1", 9, days[1])]), table, ["k"])
    assert upkeep.optimize(spark, table, cluster_by="k") == 3
    assert snapshot_table.snapshot(spark, table).folders == {
        "day=2025-01-01": 1, "day=2025-01-02": 3, "day=2025-01-03": 1,
    }
    assert upkeep.optimize(spark, table, cluster_by="v") == 4
    assert rows_of(snapshot_table.read(spark, table)) == sorted([rows[0], ("k1", 9, days[1]), rows[2]], key=str)


def test_a_day_too_big_for_one_task_is_cut(spark, table):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")  # the small days of one reduce task together stay below this
    try:
        df = spark.range(0, 120000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("k"),
            F.col("id").cast("int").alias("v"),
            F.when(F.col("id") % 3 > 0, F.lit(date(2025, 1, 1))).otherwise(F.date_add(F.lit(date(2025, 2, 1)), F.pmod("id", F.lit(20)).cast("int"))).alias("day"),
        )
        snapshot_table.overwrite(df, table, ("day",))
    finally:
        spark.conf.set(name, before)
    sizes = {r["folder"]: r["files"] for r in upkeep.file_inventory(spark, table).groupBy("folder").agg(F.count("*").alias("files")).collect()}
    assert len(sizes) == 21
    assert sizes["data_version=0/day=2025-01-01"] > 2
    assert sorted(sizes.values())[10] == 1  # most small days are one file
    assert snapshot_table.read(spark, table).count() == 120000


def admitted(table_rows, **wanted):
    """Files whose least and greatest values admit all wanted ones."""
    bounds = [f(c).alias(f"{n}_{c}") for c in wanted for n, f in (("lo", F.min), ("hi", F.max))]
    files_ = table_rows.groupBy(F.input_file_name().alias("f")).agg(*bounds).collect()
    return sum(all(r[f"lo_{c}"] <= v <= r[f"hi_{c}"] for c, v in wanted.items()) for r in files_), len(files_)


def test_clustering_by_several_columns_skips_files_for_each(spark, table):
    df = spark.range(40000).select(
        F.concat(F.lit("K-"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(500)).cast("string"), 4, "0")).alias("customer"),
        F.when(F.col("id") % 97 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)).cast("int")).alias("article"),
        F.col("id").alias("n"),
    )
    wanted = {"customer": "K-0123", "article": 150}
    found = {}
    for name, columns in (("one", "customer"), ("both", ["customer", "article"])):
        path = f"{table}-{name}"
        snapshot_table.overwrite(df, path)
        size = upkeep.file_inventory(spark, path).agg(F.sum("bytes")).first()[0]
        assert upkeep.optimize(spark, path, cluster_by=columns, target_bytes=size // 32) == 1
        now = snapshot_table.read(spark, path)
        found[name] = {k: admitted(now, **w) for k, w in {"both": wanted, "article": {"article": 150}, "customer": {"customer": "K-0123"}}.items()}
        assert now.agg(F.count("*"), F.sum("n"), F.sum("article"), F.sum(F.xxhash64("customer", "n") % 1000)).first() == df.agg(
            F.count("*"), F.sum("n"), F.sum("article"), F.sum(F.xxhash64("customer", "n") % 1000)).first()
    assert found["one"]["article"][0] == found["one"]["article"][1]  # every file may hold the article
    assert found["both"]["article"][0] <= found["both"]["article"][1] / 2
    assert found["both"]["customer"][0] <= found["both"]["customer"][1] / 2
    assert found["both"]["both"][0] <= found["both"]["both"][1] / 8
    assert upkeep.optimize(spark, f"{table}-both", cluster_by=["customer", "article"]) is None
    assert upkeep.optimize(spark, f"{table}-both", cluster_by=["article", "customer"]) == 2


def test_one_large_folder_is_shared_out_over_tasks(spark, table, monkeypatch):
    df = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    for columns in (None, "k", ["k", "v"]):
        path = f"{table}-{columns and len(columns)}"
        snapshot_table.overwrite(df.repartition(12), path, spread=False)
        size = upkeep.file_inventory(spark, path).agg(F.sum("bytes")).first()[0]
        monkeypatch.setattr(upkeep, "TASK_FILE_BYTES", size // 6)
        assert upkeep.optimize(spark, path, cluster_by=columns) == 1  # the file size aimed at is far above the table's
        assert 6 <= upkeep.file_inventory(spark, path).count() <= 8
        assert rows_of(snapshot_table.read(spark, path)) == rows_of(df)
        assert upkeep.optimize(spark, path, cluster_by=columns) is None


@pytest.mark.parametrize("columns", ["k", ["k", "v"]])
def test_upkeep_sorts_by_columns_not_expressions(spark, table, monkeypatch, columns):
    rows = [(f"k{i}", i, date(2025, 1 + i % 3, 1 + i % 20)) for i in range(60)]
    snapshot_table.overwrite(frame(spark, rows), table, ("month(day)",))
    written, inner = [], snapshot_table.replace_folders
    monkeypatch.setattr(snapshot_table, "replace_folders", lambda df, *a, **k: written.append(df) or inner(df, *a, **k))
    upkeep.optimize(spark, table, cluster_by=columns)
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    (sort,) = [line for line in plan.splitlines() if line.lstrip("+- :").startswith("Sort [")]
    assert "day_month" in sort and "(" not in sort
    now = snapshot_table.read(spark, table)
    assert now.columns == ["k", "v", "day"] and rows_of(now) == sorted(rows, key=str)


def test_parts_of_a_column_are_found_by_halving(spark):
    cuts = sorted({v * v % 131 for v in range(70)})[:63]
    df = spark.createDataFrame([(v,) for v in [None, *range(-3, 140)]], "v INT")
    for some in ([], cuts[:1], cuts[:37], cuts):
        found = {r["v"]: r["n"] for r in df.select("v", upkeep._part(F.col("v"), some, df.schema["v"].dataType).alias("n")).collect()}
        assert found == {v: 0 if v is None else sum(c <= v for c in some) for v in found}
    text = spark.createDataFrame([("a",), ("b",), ("bb",), ("z",)], "v STRING")
    kind = text.schema["v"].dataType
    assert [r["n"] for r in text.select(upkeep._part(F.col("v"), ["b", "c"], kind).alias("n")).collect()] == [0, 1, 1, 2]


def test_vacuum_counts_age_from_replacement(spark, table):
    t0 = datetime(2025, 1, 1, tzinfo=timezone.utc)
    d = [date(2025, 1, 1), date(2025, 1, 2)]
    snapshot_table.overwrite(frame(spark, [("a", 1, d[0]), ("b", 1, d[1])]), table, ("day",), committed_at=t0)
    snapshot_table.upsert(frame(spark, [("a", 2, d[0])]), table, ["k"], committed_at=t0 + timedelta(days=30))
    soon, later = t0 + timedelta(days=31), t0 + timedelta(days=38)
    assert upkeep.vacuum_candidates(spark, table, now=soon).count() == 0
    assert ids(upkeep.vacuum_candidates(spark, table, now=later), "folder") == {"data_version=0/day=2025-01-01"}
    assert upkeep.vacuum(spark, table, now=later) == ["data_version=0/day=2025-01-01"]
    assert rows_of(snapshot_table.read(spark, table)) == [("a", 2, d[0]), ("b", 1, d[1])]
    with pytest.raises(FileNotFoundError):
        snapshot_table.read(spark, table, 0)
    assert upkeep.vacuum(spark, table, now=later) == []


def test_vacuum_takes_old_leftovers_but_not_a_running_write(spark, table):
    snapshot_table.overwrite(spark.range(3), table)
    spark.range(3).write.parquet(f"{table}/data/data_version=1")
    now = datetime.now(timezone.utc)
    assert upkeep.vacuum_candidates(spark, table, now=now).count() == 0
    assert ids(upkeep.vacuum_candidates(spark, table, now=now + timedelta(days=8)), "folder") == {"data_version=1"}


def test_short_retention_needs_force(spark, table):
    snapshot_table.overwrite(spark.range(1), table)
    with pytest.raises(ValueError, match="force"):
        upkeep.vacuum_candidates(spark, table, retain_hours=1)
    assert upkeep.vacuum_candidates(spark, table, retain_hours=1, force=True).count() == 0


# ---- contracts ----------------------------------------------------------------------


def test_enforcement(spark):
    known = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    contract = known.schema
    wider = spark.createDataFrame([("extra", "y", 1)], "c STRING, b STRING, a INT")
    with pytest.raises(schemas.SchemaMismatch, match="unknown column c"):
        schemas.enforce(wider, contract)
    assert schemas.enforce(wider, contract, evolve=True).columns == ["a", "b", "c"]
    with pytest.raises(schemas.SchemaMismatch, match="missing column b"):
        schemas.enforce(known.drop("b"), contract, evolve=True)
    with pytest.raises(schemas.SchemaMismatch, match="column a is string"):
        schemas.enforce(known.withColumn("a", F.col("a").cast("string")), contract)


def test_null_report(spark):
    df = spark.createDataFrame([("T", None), (None, None)], "transaction_id STRING, currency STRING")
    got = {r["column_name"]: r["null_rows"] for r in schemas.null_report(df, schemas.SILVER_TRANSACTIONS).collect()}
    assert got == {"transaction_id": 1, "currency": 2}
    with pytest.raises(schemas.SchemaMismatch, match="1 NULLs in transaction_id"):
        schemas.assert_not_null(df, schemas.SILVER_TRANSACTIONS)


def test_upsert_into_an_empty_text_partition_loses_no_row(spark, table):
    rows = spark.createDataFrame([("a", None), ("c", "x")], "k STRING, p STRING")
    snapshot_table.write_or_upsert(rows, table, ["k"], ("p",))
    snapshot_table.write_or_upsert(spark.createDataFrame([("b", "")], "k STRING, p STRING"), table, ["k"], ("p",))
    assert {r["k"] for r in snapshot_table.read(spark, table).collect()} == {"a", "b", "c"}


def test_a_failed_replacement_keeps_the_batch(spark, table):
    append_table.append(spark.range(7), table, "day")
    broken = spark.range(4).selectExpr("id + raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        append_table.append(broken, table, "day")
    assert append_table.read(spark, table).count() == 7
    assert append_table.append(spark.range(3), table, "day") == 2
    assert append_table.read(spark, table, after=0).count() == 3
    assert append_table.read(spark, table).count() == 3
