import pytest
from conftest import CLEAN, RAW, REFUSED, ids
from pyspark.sql import functions as F

from tierline.operators.expectations import Expectation
from tierline.plans import jobs, steps
from tierline.schemas import SILVER_COLUMNS
from tierline.sources import append_table, snapshot_table


def silver_of(spark, layout):
    return snapshot_table.read(spark, layout.silver)


def test_bronze_keeps_strings_and_lineage(spark, layout, raw_rows, write_raw):
    path = write_raw(raw_rows)
    assert jobs.bronze_job(spark, layout) == 9
    bronze = append_table.read(spark, layout.bronze)
    row = bronze.filter("transaction_id = 'ORD-908'").first()
    assert row["event_ts"] == "14th of March" and row["_ingest_ts"] is not None
    assert row["_source_file"].endswith(path) and row["_source_hint"] == "transactions.csv"
    assert bronze.filter("transaction_id = 'ORD-904'").first()["customer_id"] is None
    assert bronze.filter("transaction_id = 'ORD-902'").first()["currency"] == " EUR "
    assert jobs.bronze_job(spark, layout) == 18  # an append is an append


def test_folder_source_reads_csv_only(spark, layout, raw_rows, write_raw):
    write_raw(raw_rows[:2], "a.csv")
    write_raw(raw_rows[3:], "b.csv")
    write_raw(raw_rows, "notes.txt")
    assert jobs.bronze_job(spark, layout, layout.raw) == 8


def test_missing_source(spark, layout):
    with pytest.raises(FileNotFoundError):
        jobs.bronze_job(spark, layout)
    with pytest.raises(FileNotFoundError):
        jobs.silver_job(spark, layout)


def test_header_check(spark, layout, write_raw, raw_rows, tmp_path):
    path = tmp_path / "sample_raw" / "odd.csv"
    path.write_text(f"{RAW.replace('product_id', 'article')}\nORD-7,CU-1,JAR-8,4,2,CHF,2031-07-09,ch\n")
    assert jobs.bronze_job(spark, layout, str(path)) == 1
    with pytest.raises(Exception, match="(?i)header"):
        jobs.bronze_job(spark, layout, str(path), check_header=True)


def test_end_to_end(spark, layout, raw_rows, write_raw):
    write_raw(raw_rows)
    jobs.bronze_job(spark, layout)
    counts = jobs.silver_job(spark, layout)
    assert counts == {"bronze": 9, "silver": 3, "rejects": 5, "daily_revenue": None, "customer_ltv": None}
    silver = silver_of(spark, layout)
    assert silver.columns == SILVER_COLUMNS and ids(silver) == CLEAN
    jobs.gold_job(spark, layout)
    gold = spark.table("gold_daily_revenue").agg(F.sum("gross_revenue")).first()[0]
    assert gold == pytest.approx(silver.agg(F.sum("revenue")).first()[0]) == pytest.approx(75.7)
    best = spark.table("gold_customer_ltv").orderBy(F.desc("lifetime_revenue")).collect()
    assert [(r["customer_id"], r["orders"]) for r in best] == [("CU-41", 2), ("CU-58", 1)]
    frames = jobs.dashboard_frames(spark, layout)
    assert tuple(frames["kpis"].first()) == (pytest.approx(75.7), 3, 2)
    assert frames["revenue_by_country"].columns == ["event_date", "at", "ch"]
    assert frames["top_customers"].first()["customer_id"] == "CU-41"
    rejects = append_table.read(spark, layout.rejects)
    assert ids(rejects) == REFUSED
    assert {r["_bronze_source"] for r in rejects.collect()} == {layout.bronze}
    assert rejects.filter("_bronze_source_file LIKE '%transactions.csv'").count() == 5


def test_second_ingest_and_clean_change_nothing(spark, layout, raw_rows, write_raw):
    write_raw(raw_rows)
    for _ in range(2):
        jobs.bronze_job(spark, layout)
        counts = jobs.silver_job(spark, layout)
    assert counts["bronze"] == 18 and counts["silver"] == 3
    assert counts["rejects"] == 10  # each ingest has its own five
    assert jobs.silver_job(spark, layout)["rejects"] == 10  # a rerun adds none


def test_incremental_equals_full(spark, tmp_path, raw_rows):
    from tierline.schemas import RAW_TRANSACTIONS
    from tierline.sources.layout import Layout

    batches = [
        raw_rows,
        [
            ("ORD-901", "CU-99", "PAN-2", "9", "7.00", "CHF", "2031-03-01 05:00:00", "ch"),  # an older copy
            ("ORD-903", "CU-41", "JAR-8", "8", "8.00", "CHF", "2031-03-21 09:00:00", "ch"),  # a newer copy
            ("ORD-905", "CU-77", "TEA-3", "2", "4.20", "CHF", "2031-03-16 10:30:00", "ch"),  # mended
        ],
        [("ORD-910", "CU-12", "MUG-1", "7", "11.00", "EUR", "2031-03-16 20:00:00", "li")],
    ]
    results = {}
    for mode in (False, True):
        layout = Layout(str(tmp_path / f"full-{mode}"))
        for batch in batches:
            append_table.append(spark.createDataFrame(batch, RAW_TRANSACTIONS), layout.bronze)
            counts = jobs.silver_job(spark, layout, full=mode)
        again = jobs.silver_job(spark, layout, full=mode)
        assert again == counts
        rows = silver_of(spark, layout).drop("ingest_ts").collect()
        rejects = append_table.read(spark, layout.rejects).select("transaction_id", "_bronze_ingest_version")
        results[mode] = (sorted(map(tuple, rows)), sorted(map(tuple, rejects.collect())))
    assert results[True] == results[False]
    silver = {r[0]: r for r in results[True][0]}
    assert silver["ORD-901"][1] == "CU-41" and silver["ORD-903"][3] == 8
    assert set(silver) == CLEAN | {"ORD-905", "ORD-910"}


def test_incremental_without_news_writes_no_version(spark, layout, raw_rows, write_raw):
    write_raw(raw_rows)
    jobs.bronze_job(spark, layout)
    for _ in range(2):
        jobs.silver_job(spark, layout)
    assert snapshot_table.versions(spark, layout.silver) == [0]


def test_maintenance(spark, layout, raw_rows, write_raw):
    write_raw(raw_rows)
    jobs.bronze_job(spark, layout)
    jobs.silver_job(spark, layout)
    before = sorted(map(tuple, silver_of(spark, layout).collect()))
    assert jobs.maintenance_job(spark, layout) == []
    assert sorted(map(tuple, silver_of(spark, layout).collect())) == before
    assert jobs.silver_job(spark, layout)["silver"] == 3


# ---- declared steps -----------------------------------------------------------------


@pytest.fixture
def declared_rows(raw_rows):
    """The rules ask for no customer and let NaN pass, so that price is a negative one here."""
    return [(*r[:4], "-0.50" if r[4] == "NaN" else r[4], *r[5:]) for r in raw_rows]


def test_declared_steps(spark, layout, declared_rows, write_raw):
    write_raw(declared_rows)
    jobs.bronze_job(spark, layout)
    for expected in ({"silver_transactions": 0, "gold_daily_revenue": 0}, {"silver_transactions": 1, "gold_daily_revenue": 1}):
        assert steps.declarative_job(spark, layout) == expected
    assert ids(silver_of(spark, layout)) == CLEAN | {"ORD-904"}
    rejects = append_table.read(spark, layout.rejects)
    assert {(r["transaction_id"], r["_expectation"]) for r in rejects.collect()} == {
        ("ORD-905", "positive_qty"), ("ORD-906", "positive_qty"), ("ORD-907", "non_negative_price"), ("ORD-908", "real_ts"),
    }
    assert rejects.count() == 4 and "_rejected_at" in rejects.columns
    narrow = snapshot_table.read(spark, layout.daily_narrow)
    assert narrow.columns == ["event_date", "country", "gross_revenue"]
    assert narrow.agg(F.sum("gross_revenue")).first()[0] == pytest.approx(79.9)
    built = steps.declared_builds(spark, layout)
    assert built["silver_transactions"].caught == {"non_null_id": 0, "positive_qty": 2, "non_negative_price": 1, "real_ts": 1}
    assert built["silver_transactions"].rows == 4


def test_broken_fail_rule_keeps_the_old_version(spark, layout, declared_rows, write_raw):
    write_raw(declared_rows)
    jobs.bronze_job(spark, layout)
    steps.declarative_job(spark, layout)
    write_raw([("", "CU-3", "JAR-8", "4", "2", "CHF", "2031-07-09", "ch")])
    jobs.bronze_job(spark, layout)
    with pytest.raises(ValueError, match="'non_null_id' failed on 1 rows: transaction_id IS NOT NULL"):
        steps.declarative_job(spark, layout)
    assert snapshot_table.versions(spark, layout.silver) == [0]
    assert ids(silver_of(spark, layout)) == CLEAN | {"ORD-904"}


def test_a_step_counts_what_its_rules_caught(spark, table, caplog):
    rules = (Expectation("small", "id < 4", "drop"), Expectation("even", "id % 2 = 0", "quarantine"))
    step = steps.Step(table, lambda spark: spark.range(10), steps.Checks(rules, table + "_odd"))
    with caplog.at_level("INFO"):
        built = steps.build(spark, "evens", step, "d")
    assert built == steps.Built(0, 2, {"small": 6, "even": 2})
    assert ids(snapshot_table.read(spark, table), "id") == {0, 2}
    assert ids(append_table.read(spark, table + "_odd"), "id") == {1, 3}
    assert "small dropped 6 rows" in caplog.text
    # The same delivery again: its rejects are replaced, and nothing of the earlier ones is left.
    assert steps.build(spark, "evens", step, "d").version == 1
    assert append_table.rows(spark, table + "_odd") == 2 and append_table.replaced(spark, table + "_odd") == []


def test_a_step_without_quarantine_writes_no_rejects(spark, table):
    step = steps.Step(table, lambda spark: spark.range(3), steps.Checks((Expectation("none", "id < 0", "drop"),), table + "_r"))
    assert steps.build(spark, "s", step) == steps.Built(0, 0, {"none": 3})
    assert append_table.latest_version(spark, table + "_r") is None
    plain = steps.Step(table, lambda spark: spark.range(5))
    assert steps.build(spark, "s", plain) == steps.Built(1, 5, {})
