"""CSV files read by their own headers."""

from pathlib import Path

import pytest
from conftest import CLEAN, RAW, ids

from tierline.__main__ import main
from tierline.plans import jobs
from tierline.schemas import RAW_COLUMNS, SchemaMismatch
from tierline.sources import append_table, changing_feed, snapshot_table

PLAIN = f"{RAW}\nORD-1,CU-1,TEA-3,6,4.20,CHF,2031-03-14 07:45:10,ch\n"
#: Another order, a column with a comma in its name, one without a name.
MOVED = (
    'country,Store,"shelf, row",transaction_id,,event_ts,unit_price,quantity,product_id,customer_id,currency\n'
    'at,Graz,"7, 2",ORD-2,x,2031-03-15 18:20:00,11.50,3,MUG-1,CU-2,EUR\n'
)
#: Padded and spelt otherwise, without currency and price.
SHORT = "\n \n Transaction_ID ,STORE,CUSTOMER_ID\nORD-3,Wien,\nORD-4,,CU-4\n"


@pytest.fixture
def folder(layout):
    raw = Path(layout.raw)
    for name, text in {
        "a.csv": PLAIN, "b.csv": MOVED, "c.csv": SHORT, "d.csv": "", "e.csv": RAW + "\n", "notes.txt": "transaction_id\nORD-9\n",
    }.items():
        (raw / name).write_text(text)
    return str(raw)


def test_each_file_goes_by_its_header(spark, folder):
    df = changing_feed.read_changing_csv(spark, folder, "raw")
    assert df.columns == [*RAW_COLUMNS, "Store", "_c4", "shelf, row", "_source_file", "_source_hint", "_ingest_ts"]
    got = {r["transaction_id"]: r.asDict() for r in df.collect()}
    assert set(got) == {"ORD-1", "ORD-2", "ORD-3", "ORD-4"}
    assert [got["ORD-1"][c] for c in RAW_COLUMNS] == PLAIN.splitlines()[1].split(",")
    assert got["ORD-1"]["Store"] is None and got["ORD-1"]["_source_file"].endswith("a.csv")
    second = got["ORD-2"]
    assert [second[c] for c in RAW_COLUMNS] == "ORD-2,CU-2,MUG-1,3,11.50,EUR,2031-03-15 18:20:00,at".split(",")
    assert (second["Store"], second["shelf, row"], second["_c4"]) == ("Graz", "7, 2", "x")
    assert (got["ORD-3"]["Store"], got["ORD-3"]["customer_id"], got["ORD-3"]["currency"]) == ("Wien", None, None)
    assert (got["ORD-4"]["Store"], got["ORD-4"]["customer_id"]) == (None, "CU-4")
    assert {r["_source_hint"] for r in got.values()} == {"raw"}


def test_files_with_one_header_are_one_scan(spark, layout):
    for i in range(5):
        (Path(layout.raw) / f"{i}.csv").write_text(PLAIN.replace("ORD-1", f"ORD-{i}"))
    groups = changing_feed.header_groups(spark, layout.raw)
    assert {k: len(v) for k, v in groups.items()} == {tuple(RAW_COLUMNS): 5}
    assert ids(changing_feed.read_changing_csv(spark, layout.raw)) == {f"ORD-{i}" for i in range(5)}


def test_headers_of_large_files(spark, layout):
    line = PLAIN.splitlines()[1]
    for i in range(3):
        body = "\n".join(line.replace("ORD-1", f"ORD-{i}-{j}") for j in range(60_000))
        (Path(layout.raw) / f"{i}.csv").write_text(f"{RAW},extra{i}\n{body}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    df = changing_feed.read_changing_csv(spark, layout.raw)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert {"extra0", "extra1", "extra2"} < set(df.columns)
    assert df.select("transaction_id").distinct().count() == df.count() == 180_000


@pytest.mark.parametrize(
    "header, problem",
    [
        ("transaction_id,country,Country", "column country occurs twice"),
        ("customer_id,country", "missing column transaction_id"),
        ("transaction_id,_ingest_ts", "column _ingest_ts is not for raw files"),
        ("transaction_id,Batch_Key", "column Batch_Key is not for raw files"),
    ],
)
def test_headers_that_are_refused(spark, layout, header, problem):
    (Path(layout.raw) / "ok.csv").write_text(PLAIN)
    (Path(layout.raw) / "odd.csv").write_text(header + "\n1,2,3\n")
    with pytest.raises(SchemaMismatch, match=f"odd.csv: {problem}"):
        changing_feed.header_groups(spark, layout.raw)


def test_no_header_anywhere(spark, layout):
    (Path(layout.raw) / "empty.csv").write_text("")
    for source in (layout.raw, layout.raw + "/none.csv"):
        with pytest.raises(FileNotFoundError):
            changing_feed.read_changing_csv(spark, source)


def test_bronze_grows_and_silver_follows(spark, layout, raw_rows, write_raw):
    path = write_raw(raw_rows)
    assert jobs.bronze_job(spark, layout, path, by_header=True) == 9
    (Path(layout.raw) / "b.csv").write_text(MOVED)
    assert main(["--root", layout.root, "bronze", "--source", layout.raw + "/b.csv", "--by-header"]) == 10
    bronze = append_table.read(spark, layout.bronze)
    assert {"Store", "shelf, row"} < set(bronze.columns)
    assert [r["Store"] for r in bronze.where("Store is not null").collect()] == ["Graz"]
    jobs.silver_job(spark, layout)
    assert ids(snapshot_table.read(spark, layout.silver)) == CLEAN | {"ORD-2"}


def test_either_checked_or_by_header(spark, layout):
    with pytest.raises(ValueError, match="not checked"):
        jobs.bronze_job(spark, layout, check_header=True, by_header=True)
