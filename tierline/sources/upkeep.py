"""Compaction, clustering and retention of snapshot tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tierline.sources import files, snapshot_table
from tierline.sources.settings import few_listing_tasks
from tierline.sources.snapshot_table import Snapshot

# File size aimed at, and the shortest retention allowed without force.
TARGET_FILE_BYTES = 1 << 30
MIN_RETAIN_HOURS = 168
# A file is the work of one task, which reads its rows from a shuffle at about twice the file's size, so a file
# stops here. A folder with more than the least is shared out while there are cores.
TASK_FILE_BYTES = 256 << 20
LEAST_FILE_BYTES = 32 << 20

# Parts of a column are numbered with so many bits, from so many rows.
CURVE_BITS = 6
CURVE_SAMPLE = 10_000
_ALONG = "_along_curve"

_FOLDER = r"/data/(data_version=\d+(?:/[^/]+=[^/]+)*)/[^/]+$"


def _listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file; names and sizes only, contents are not opened."""
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
    )
    with few_listing_tasks(spark):
        found = reader.load(paths)
    return found.select(
        F.regexp_extract("path", _FOLDER, 1).alias("folder"),
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def file_inventory(spark: SparkSession, table: str, snap: Snapshot | None = None) -> DataFrame:
    """Files of a version: folder, path, bytes, modified_at."""
    snap = snap or snapshot_table.snapshot(spark, table)
    return _listing(spark, snap.paths(table))


def optimize(
    spark: SparkSession,
    table: str,
    cluster_by: str | Sequence[str] | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> int | None:
    """Rewrite small files into files near ``target_bytes``, or near TASK_FILE_BYTES if that is less; rows stay the same.

    With ``cluster_by`` partitions not yet clustered by that column are rewritten, sorted on
    it, so that a filter on it skips files. With several columns rows are ordered along a curve through
    all of them (``interleaved``), so that a filter on any of them, or on all, skips files. Without it
    partitions with more files than they need are rewritten. What an earlier call wrote and nothing touched since is left alone; None is
    returned if nothing is left to do.

    Rows are range-partitioned on partition, cluster column and a row hash: a partition
    or a cluster value that holds a large part of the table is still cut into pieces of
    the same size.
    """
    snap = snapshot_table.snapshot(spark, table)
    columns = [cluster_by] if isinstance(cluster_by, str) else list(cluster_by or ())
    mark = ",".join(columns)
    file_bytes = min(target_bytes, TASK_FILE_BYTES)
    todo = [
        f
        for f, v in snap.folders.items()
        if v not in snap.packed or (columns and snap.packed[v] != mark)
    ]
    if not todo:
        return None
    sizes = (
        _listing(spark, snap.paths(table, todo))
        .groupBy("folder")
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    )
    if not columns:
        sizes = sizes.filter(F.col("files") > F.ceil(F.col("bytes") / F.lit(file_bytes)))
    chosen = {r["folder"]: r["bytes"] for r in sizes.collect()}  # one row per partition folder
    rewritten = [f for f in todo if f"data_version={snap.folders[f]}/{f}".rstrip("/") in chosen]
    if not rewritten:
        return None
    # At least one task per core while there are folders, or bytes, to go round: a cut through a
    # folder adds one file, and with many small folders files cost more than bytes.
    whole_bytes = sum(chosen.values())
    shares = max(len(rewritten), whole_bytes // LEAST_FILE_BYTES)
    pieces = max(math.ceil(whole_bytes / file_bytes), min(shares, spark.sparkContext.defaultParallelism))
    rows = snapshot_table.read_folders(spark, table, snap, rewritten)
    # What rows are sorted by is computed once a row: a sort evaluates its expressions for each comparison.
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    keyed = rows.withColumn(_ALONG, interleaved(rows, columns)) if len(columns) > 1 else rows
    along = [_ALONG] if len(columns) > 1 else columns
    order = [F.col(f"`{c}`") for c in [*snapshot_table.folder_columns(snap.partition_by), *along]]
    packed = snapshot_table.with_folders(keyed, snap.partition_by).repartitionByRange(pieces, *order, whole)
    if order:
        packed = packed.sortWithinPartitions(*order)
    packed = packed.drop(_ALONG)
    return snapshot_table.replace_folders(
        packed, table, snap, rewritten, snapshot_table.UPKEEP, packed_by=mark, gained=0
    )


def _cuts(rows: DataFrame, column: str) -> list:
    """Up to 2 ** CURVE_BITS - 1 values that cut a bounded sample of a column into equal parts."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    values = rows.select(F.col(f"`{column}`").alias("v"), whole.alias("h")).where("v IS NOT NULL")
    # The rows with the smallest hashes: the same ones in every run, each task sends its first.
    drawn = sorted((r["v"] for r in values.orderBy("h").limit(CURVE_SAMPLE).collect()), key=_nan_last)
    parts = 1 << CURVE_BITS
    return sorted({drawn[len(drawn) * i // parts] for i in range(1, parts)}, key=_nan_last) if drawn else []


def _nan_last(value) -> tuple:
    """Spark's order: NaN is above every number."""
    return (value != value, value)


def interleaved(rows: DataFrame, columns: Sequence[str]) -> Column:
    """A key that keeps rows near each other which are near in all ``columns``.

    Each value becomes the number of the part of the column it falls in, NULL the first; the bits of
    these numbers are woven together, the highest first. The parts come from a sample of CURVE_SAMPLE
    rows of each column: they say how well files can be skipped, never where a row belongs.
    """
    if len(columns) * CURVE_BITS > 62:
        raise ValueError(f"at most {62 // CURVE_BITS} columns can be woven together")
    key = F.lit(0).cast("bigint")
    for i, column in enumerate(columns):
        part = _part(F.col(f"`{column}`"), _cuts(rows, column), rows.schema[column].dataType)
        # Each part's bits, moved to their places, from a table: the part is found once a row.
        moved = [
            sum((n >> bit & 1) << (bit * len(columns) + len(columns) - 1 - i) for bit in range(CURVE_BITS))
            for n in range(1 << CURVE_BITS)
        ]
        key = key.bitwiseOR(F.get(F.array(*[F.lit(m).cast("bigint") for m in moved]), part))
    return key


def _part(value: Column, cuts: list, kind: DataType) -> Column:
    """How many of the cuts, which are in order, are not above the value; 0 for NULL."""
    if not cuts:
        return F.lit(0)
    sorted_cuts = F.array(*[F.lit(c).cast(kind) for c in cuts])
    # Halving steps; beyond the last cut there is NULL, which holds nothing back and adds nothing.
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(CURVE_BITS))])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(sorted_cuts, at + step - 1) <= value, at + step).otherwise(at)
    )
    return F.when(value.isNull(), 0).otherwise(found)


def _live(history: list[Snapshot], cutoff: datetime) -> list[Snapshot]:
    """The newest version, and those replaced after the cutoff."""
    kept = [old for old, new in zip(history, history[1:]) if new.committed_at > cutoff]
    return kept + history[-1:]


def _cutoff(retain_hours: float, force: bool, now: datetime | None) -> datetime:
    if retain_hours < MIN_RETAIN_HOURS and not force:
        raise ValueError(
            f"retention of {retain_hours} h is below {MIN_RETAIN_HOURS} h; pass force=True to allow it"
        )
    return (now or datetime.now(timezone.utc)) - timedelta(hours=retain_hours)


def vacuum_candidates(
    spark: SparkSession,
    table: str,
    retain_hours: float = MIN_RETAIN_HOURS,
    force: bool = False,
    now: datetime | None = None,
) -> DataFrame:
    """Data folders that no live version needs: folder, files, bytes.

    A version's age counts from its replacement, not from when its files were written.
    Folders in no version at all (a failed write) are listed once they are old enough,
    so a write in progress is left alone.
    """
    cutoff = _cutoff(retain_hours, force, now)
    history = snapshot_table.snapshots(spark, table)
    if not history:
        raise FileNotFoundError(f"no committed version of {table}")

    def folders(snaps: list[Snapshot]) -> set[str]:
        return {f"data_version={v}/{f}".rstrip("/") for s in snaps for f, v in s.folders.items()}

    live = folders(_live(history, cutoff))
    known = [(f, f in live) for f in folders(history)]
    referenced = spark.createDataFrame(known, "folder STRING, live BOOLEAN")
    return (
        _listing(spark, [f"{table}/data"])
        .join(referenced, "folder", "left")
        .filter(~F.coalesce("live", F.col("modified_at") >= F.lit(cutoff)))
        .groupBy("folder")
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    )


def vacuum(
    spark: SparkSession,
    table: str,
    retain_hours: float = MIN_RETAIN_HOURS,
    force: bool = False,
    now: datetime | None = None,
) -> list[str]:
    """Delete what ``vacuum_candidates`` lists, and the versions that needed it."""
    dead = [
        r["folder"]
        for r in vacuum_candidates(spark, table, retain_hours, force, now).collect()
    ]  # folder names, not rows
    history = snapshot_table.snapshots(spark, table)
    live = {s.version for s in _live(history, _cutoff(retain_hours, force, now))}
    for old in history:
        if old.version not in live:
            files.delete(spark, f"{table}/snapshots/version={old.version}")
    for folder in dead:
        files.delete(spark, f"{table}/data/{folder}")
    return sorted(dead)
