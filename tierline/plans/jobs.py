"""Bronze, Silver, Gold and maintenance jobs over a lakehouse layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import clean, dashboard
from tierline.plans import increments
from tierline.schemas import BRONZE_TRANSACTIONS, SILVER_COLUMNS
from tierline.sources import append_table, snapshot_table, upkeep
from tierline.sources.changing_feed import read_changing_csv
from tierline.sources.csv_feed import read_raw_csv, with_lineage
from tierline.sources.layout import Layout

_LINEAGE = ("_source_file", append_table.VERSION, append_table.KEY)


def bronze_job(
    spark: SparkSession,
    layout: Layout,
    source: str | None = None,
    check_header: bool = False,
    batch_key: str | None = None,
    by_header: bool = False,
) -> int:
    """Append raw files to Bronze and return the rows it holds, as counted by the jobs that wrote them.

    Reruns append again, unless a ``batch_key`` names the delivery: the same key replaces it.
    With ``by_header`` each file is read by its own header, and columns it adds become columns of Bronze.
    """
    if by_header and check_header:
        raise ValueError("files read by their own headers are not checked against the schema")
    source = source or f"{layout.raw}/transactions.csv"
    hint = source.rstrip("/").rsplit("/", 1)[-1]
    if by_header:
        rows = read_changing_csv(spark, source, hint)
    else:
        rows = with_lineage(read_raw_csv(spark, source, check_header), hint)
    append_table.append(rows, layout.bronze, batch_key)
    return append_table.rows(spark, layout.bronze)


def read_bronze(
    spark: SparkSession, layout: Layout, as_of: int | None = None, after: int | None = None
) -> DataFrame:
    """Bronze rows under the contract, which spares reading file footers for a schema."""
    return append_table.read(spark, layout.bronze, as_of, after, BRONZE_TRANSACTIONS)


def silver_job(spark: SparkSession, layout: Layout, full: bool = False) -> dict[str, int | None]:
    """Clean Bronze into Silver by merge, append new rejects, return row counts.

    Only Bronze versions Silver has not seen are read; with ``full`` Silver is built anew from all
    of Bronze. Copies of a transaction that are in Silver already compete with the new ones in the
    same order, and a transaction that was in a batch replaced since is judged anew on what Bronze
    holds of it now, so both ways give the same Silver table.

    Rejects of a Bronze version are written once: the batch key names the versions
    covered, and versions covered before are left out. Those of a replaced batch stay, with its version.
    """
    upto = append_table.latest_version(spark, layout.bronze)
    if upto is None:
        raise FileNotFoundError(f"nothing ingested at {layout.bronze}")
    seen = None
    if not full and snapshot_table.latest_version(spark, layout.silver) is not None:
        seen = snapshot_table.snapshot(spark, layout.silver).source_version
    if seen is None:
        silver = clean.silver(read_bronze(spark, layout, as_of=upto))
        snapshot_table.overwrite(silver, layout.silver, (layout.silver_by,), "rebuild", upto)
    elif upto > seen:
        snapshot_table.merge(
            silver_changes(spark, layout, seen, upto),
            layout.silver,
            [clean.KEY],
            update_if=f"s.{_CHANGE} = '{_JUDGED}' OR s.event_ts >= t.event_ts",
            insert_if=f"s.{_CHANGE} <> '{_GONE}'",
            delete_if=f"s.{_CHANGE} = '{_GONE}'",
            source_version=upto,
            operation="upsert",
        )
    _write_rejects(spark, layout, upto)
    # Silver has taken in what they held.
    append_table.drop_replaced(spark, layout.bronze, upto)
    return layer_counts(spark, layout)


# How a row of Silver changes: it competes with the copy that is there, it was judged anew, or no copy is left.
_CHANGE = "_merge_change"
_COMPETES, _JUDGED, _GONE = "competes", "judged", "gone"
# Marks rows whose key was in a batch replaced since.
_OLD = "_replaced"


def silver_changes(spark: SparkSession, layout: Layout, seen: int, upto: int) -> DataFrame:
    """What Bronze versions after ``seen`` change in Silver: one row per transaction, with the kind of change.

    The keys of batches that were replaced are looked up in all of Bronze; only their copies are cleaned again.
    Each such key also comes as a row of its own with no time, which is last in order: it stays if no copy is left.
    """
    gone = append_table.replaced(spark, layout.bronze, upto=seen)
    if not gone:
        return clean.silver(read_bronze(spark, layout, as_of=upto, after=seen)).withColumn(_CHANGE, F.lit(_COMPETES))
    old = append_table.read_batches(spark, layout.bronze, gone, BRONZE_TRANSACTIONS)
    keys = old.where(F.col(clean.KEY).isNotNull()).select(clean.KEY, F.lit(True).alias(_OLD)).distinct()
    raw = read_bronze(spark, layout, as_of=upto).join(keys, clean.KEY, "left")
    raw = raw.where(F.col(_OLD) | (F.col(append_table.VERSION) > seen))
    copies = clean.clean_rows(clean.typed(raw, (append_table.VERSION, _OLD)))
    best = clean.deduplicated(copies.unionByName(keys, allowMissingColumns=True))
    change = F.when(F.col("event_ts").isNull(), _GONE).when(F.col(_OLD), _JUDGED).otherwise(_COMPETES)
    return clean.derived(best).select(*SILVER_COLUMNS, change.alias(_CHANGE))


def _write_rejects(spark: SparkSession, layout: Layout, upto: int) -> None:
    covered = [
        int(a.key.rsplit("-", 1)[-1])
        for a in append_table.committed(spark, layout.rejects)
        if a.key.startswith("bronze-")
    ]
    after = max(covered, default=None)
    if after is not None and after >= upto:
        return
    raw = read_bronze(spark, layout, as_of=upto, after=after)
    rejects = clean.silver_rejects(raw, layout.bronze, keep=_LINEAGE)
    rejects = rejects.withColumnsRenamed({c: f"_bronze_{c.lstrip('_')}" for c in _LINEAGE})
    append_table.append(rejects, layout.rejects, f"bronze-{-1 if after is None else after}-{upto}")


def maintenance_job(spark: SparkSession, layout: Layout, retain_hours: float = 168) -> list[str]:
    """Compact Silver, clustered by customer, and drop what old versions left behind."""
    upkeep.optimize(spark, layout.silver, cluster_by="customer_id")
    return upkeep.vacuum(spark, layout.silver, retain_hours)


def gold_job(spark: SparkSession, layout: Layout, full: bool = False) -> increments.Refreshed:
    """Bring both marts up to Silver and register them as temporary views.

    Only days that changed since the marts were made are read from Silver; see ``increments``.
    """
    done = increments.refresh(spark, layout, full)
    register_views(spark, layout)
    return done


def register_views(spark: SparkSession, layout: Layout) -> None:
    for name, path in (
        ("gold_daily_revenue", layout.daily_revenue),
        ("gold_customer_ltv", layout.customer_ltv),
    ):
        snapshot_table.read(spark, path).createOrReplaceTempView(name)


def dashboard_frames(spark: SparkSession, layout: Layout, top: int = 20) -> dict[str, DataFrame]:
    """The three dashboard panels, lazily."""
    daily = snapshot_table.read(spark, layout.daily_revenue)
    ltv = snapshot_table.read(spark, layout.customer_ltv)
    return {
        "kpis": dashboard.kpis(daily, ltv),
        "revenue_by_country": dashboard.revenue_by_country(daily),
        "top_customers": dashboard.top_customers(ltv, top),
    }


def layer_counts(spark: SparkSession, layout: Layout) -> dict[str, int | None]:
    """Rows per table, None for one that does not exist, as counted by the jobs that wrote them."""
    return {
        "bronze": append_table.rows(spark, layout.bronze),
        "silver": snapshot_table.rows(spark, layout.silver),
        "rejects": append_table.rows(spark, layout.rejects),
        "daily_revenue": snapshot_table.rows(spark, layout.daily_revenue),
        "customer_ltv": snapshot_table.rows(spark, layout.customer_ltv),
    }
