from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

RAW = "transaction_id,customer_id,product_id,quantity,unit_price,currency,event_ts,country"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tierline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(tmp_path) -> str:
    return str(tmp_path / "table")


@pytest.fixture
def raw_rows() -> list[tuple]:
    """Three clean orders, one of them twice, and one order for each kind of fault."""
    return [
        ("ORD-901", "CU-41", "TEA-3", "6", "4.20", "CHF", "2031-03-14 07:45:10", "Ch "),
        ("ORD-902", "CU-58", "MUG-1", "3", "11.50", " EUR ", "2031-03-15 18:20:00", " AT"),
        ("ORD-901", "CU-41", "TEA-3", "6", "4.20", "CHF", "2031-03-14 07:45:10", "Ch "),
        ("ORD-903", "CU-41", "JAR-8", "2.75", "8.00", "CHF", "2031-03-15 09:00:00", "ch"),  # two whole jars
        ("ORD-904", "", "TEA-3", "1", "4.20", "CHF", "2031-03-16 10:00:00", "ch"),
        ("ORD-905", "CU-77", "TEA-3", "0", "4.20", "CHF", "2031-03-16 10:30:00", "ch"),
        ("ORD-906", "CU-77", "TEA-3", "five", "4.20", "CHF", "2031-03-16 11:00:00", "ch"),
        ("ORD-907", "CU-80", "MUG-1", "1", "NaN", "EUR", "2031-03-17 12:00:00", "at"),
        ("ORD-908", "CU-80", "MUG-1", "1", "11.50", "EUR", "14th of March", "at"),
    ]


#: Of the rows above: orders that are clean, and orders that are refused.
CLEAN, REFUSED = {"ORD-901", "ORD-902", "ORD-903"}, {f"ORD-90{i}" for i in range(4, 9)}


@pytest.fixture
def raw(spark, raw_rows):
    from tierline.schemas import RAW_TRANSACTIONS

    return spark.createDataFrame(raw_rows, RAW_TRANSACTIONS)


@pytest.fixture
def layout(tmp_path):
    from tierline.sources.layout import Layout

    (tmp_path / "sample_raw").mkdir()
    return Layout(str(tmp_path))


@pytest.fixture
def write_raw(layout):
    """Write raw rows as one CSV file of the layout; returns its path."""

    def write(rows, name="transactions.csv"):
        path = Path(layout.raw) / name
        path.write_text("\n".join([RAW, *(",".join(r) for r in rows)]) + "\n")
        return str(path)

    return write


def ids(df, column="transaction_id"):
    return {r[0] for r in df.select(column).collect()}
