import time
from pathlib import Path

import pytest
from conftest import ids

from tierline.plans import jobs
from tierline.sources import append_table
from tierline.streaming import ingest

ROWS = [
    (f"ORD-{i}", f"CU-{i % 4}", "PAN-2", str(2 * i), "3.30", "CHF", f"2031-04-0{i} 13:00:00", "ch") for i in range(1, 7)
]


def drain(spark, layout, **kwargs):
    return ingest.ingest_available(spark, layout.raw, layout.bronze, layout.checkpoint("bronze"), **kwargs)


def test_drain_rerun_and_new_file(spark, layout, write_raw):
    write_raw(ROWS[:3])
    (Path(layout.raw) / "notes.txt").write_text("no rows here\n")
    assert drain(spark, layout) == 3
    assert ids(append_table.read(spark, layout.bronze)) == {"ORD-1", "ORD-2", "ORD-3"}
    assert Path(layout.checkpoint("bronze")).exists()
    assert drain(spark, layout) == 3
    write_raw(ROWS[3:4], "more.csv")
    assert drain(spark, layout) == 4
    bronze = append_table.read(spark, layout.bronze)
    assert bronze.filter("_source_file LIKE '%more.csv'").count() == 1


def test_several_batches(spark, layout, write_raw):
    for i, row in enumerate(ROWS):
        write_raw([row], f"f{i}.csv")
    assert drain(spark, layout, max_files_per_trigger=2) == 6
    assert append_table.latest_version(spark, layout.bronze) == 2


def test_replayed_batch_replaces_itself(spark, layout, write_raw, tmp_path):
    write_raw(ROWS[:2])
    drain(spark, layout)
    # A stop between the Bronze write and the checkpoint's commit entry: the entry is missing.
    checkpoint = Path(layout.checkpoint("bronze"))
    for entry in (checkpoint / "commits").iterdir():
        entry.unlink()
    assert drain(spark, layout) == 2


def test_new_checkpoint_does_not_touch_old_batches(spark, layout, write_raw):
    write_raw(ROWS[:2])
    drain(spark, layout)
    total = ingest.ingest_available(spark, layout.raw, layout.bronze, layout.checkpoint("other"))
    assert total == 4


def test_batch_and_stream_share_bronze(spark, layout, write_raw):
    write_raw(ROWS[:2])
    jobs.bronze_job(spark, layout)
    assert drain(spark, layout) == 4
    bronze = append_table.read(spark, layout.bronze)
    assert bronze.filter("_source_hint IS NULL").count() == 2
    assert jobs.silver_job(spark, layout)["silver"] == 2


def test_a_drain_tells_what_it_took(spark, layout, write_raw, monkeypatch):
    for i, row in enumerate(ROWS):
        write_raw([row], f"f{i}.csv")
    run = lambda: ingest.drain(spark, layout.raw, layout.bronze, layout.checkpoint("bronze"), 4)
    monkeypatch.setattr(append_table, "read_batches", lambda *a: pytest.fail("Bronze was read"))
    assert run() == ingest.Drained(2, 6, 6)
    assert run() == ingest.Drained(0, 0, 6)
    write_raw(ROWS[:3], "late.csv")
    assert run() == ingest.Drained(1, 3, 9)


def test_empty_folder(spark, layout):
    assert drain(spark, layout) == 0


def test_continuous_query_is_handed_back_running(spark, layout, write_raw):
    write_raw(ROWS[:1])
    query = ingest.start(
        ingest.raw_stream(spark, layout.raw), layout.bronze, layout.checkpoint("bronze"), once=False
    )
    try:
        assert query.isActive
        until = time.time() + 60
        while append_table.latest_version(spark, layout.bronze) is None and time.time() < until:
            time.sleep(0.2)
        assert append_table.read(spark, layout.bronze).count() == 1
    finally:
        query.stop()
        query.awaitTermination()
