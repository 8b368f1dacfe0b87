"""Tables replaced version by version, rewriting only the partitions that change.

    <table>/data/data_version=<n>/[<column>=<value>/]part-*.parquet
    <table>/snapshots/version=<n>/      one row: which data folders make up version n

A table is divided by columns, or, with ``month(<column>)``, by the month of a date: then the days of a
month share files, which is cheaper as long as a day has few rows. The column itself stays in the files.

A version is visible once its snapshot row is written, which happens last. Old
versions stay readable, and partitions an upsert did not touch are shared between
versions. The snapshot row lists partition folders, not rows, so what the driver
handles grows with the number of partitions only. One writer per table at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.schemas import enforce
from tierline.sources import counted, files
from tierline.sources.scratch import staged
from tierline.sources.settings import few_listing_tasks

_SNAPSHOT_SCHEMA = (
    "folders MAP<STRING, BIGINT>, partition_by ARRAY<STRING>, table_schema STRING, "
    "operation STRING, source_version BIGINT, packed MAP<BIGINT, STRING>, committed_at TIMESTAMP"
)
UPKEEP = "optimize"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# 1 in rows that an upsert brings, 0 in those it finds, while both are resolved.
DELIVERED = "_delivered"
_IN, _TO = "_in_partition", "_to_partition"
_MONTH = re.compile(r"month\((.+)\)$")
_ACTION = "_action"
_INSERT, _UPDATE, _DELETE, _KEEP = "insert", "update", "delete", "keep"


@dataclass(frozen=True)
class Snapshot:
    version: int
    folders: dict[str, int]  # partition folder ("" for an unpartitioned table) -> data version
    partition_by: tuple[str, ...]
    schema: StructType
    operation: str
    source_version: int | None
    packed: dict[int, str]  # data version written by upkeep -> column it is clustered by, or ""
    committed_at: datetime

    def paths(self, table: str, folders: list[str] | None = None) -> list[str]:
        chosen = self.folders if folders is None else folders
        return [f"{table}/data/data_version={self.folders[f]}/{f}".rstrip("/") for f in chosen]


def _quoted(column: str) -> str:
    return f"`{column}`"


class DuplicateSourceKeys(ValueError):
    """Several update rows match one table row, so the result would be arbitrary."""


class Merged(NamedTuple):
    """What a merge did; without a change no version is written and the last one is given."""

    version: int
    inserted: int
    updated: int
    deleted: int


def folder_columns(partition_by: tuple[str, ...]) -> dict[str, Column]:
    """The folder name of each entry of ``partition_by`` and what a row has there."""
    out = {}
    for entry in partition_by:
        hit = _MONTH.match(entry)
        if hit:
            out[f"{hit[1]}_month"] = F.date_format(F.col(_quoted(hit[1])), "yyyy-MM")
        else:
            out[entry] = F.col(_quoted(entry))
    return out


def with_folders(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """``df`` with a column for each folder name; those of months are made for the write and are no part of a table."""
    return df.withColumns({n: c for n, c in folder_columns(partition_by).items() if n not in partition_by})


def versions(spark: SparkSession, table: str) -> list[int]:
    done = files.matching(spark, f"{table}/snapshots/version=*/_SUCCESS")
    return sorted(int(p.split("version=")[-1].split("/")[0]) for p in done)


def latest_version(spark: SparkSession, table: str) -> int | None:
    done = versions(spark, table)
    return done[-1] if done else None


def snapshots(spark: SparkSession, table: str, only: list[int] | None = None) -> list[Snapshot]:
    """Committed snapshots in version order; ``only`` picks versions."""
    wanted = versions(spark, table) if only is None else only
    if not wanted:
        return []
    rows = (
        spark.read.schema(f"{_SNAPSHOT_SCHEMA}, version BIGINT")
        .option("basePath", f"{table}/snapshots")
        .parquet(*[f"{table}/snapshots/version={v}" for v in wanted])
        .collect()
    )
    found = [
        Snapshot(
            version=r["version"],
            folders=dict(r["folders"]),
            partition_by=tuple(r["partition_by"]),
            schema=StructType.fromJson(json.loads(r["table_schema"])),
            operation=r["operation"],
            source_version=r["source_version"],
            packed=dict(r["packed"]),
            committed_at=r["committed_at"].astimezone(timezone.utc),
        )
        for r in rows
    ]
    return sorted(found, key=lambda s: s.version)


def snapshot(spark: SparkSession, table: str, version: int | None = None) -> Snapshot:
    at = latest_version(spark, table) if version is None else version
    if at is None or at not in versions(spark, table):
        raise FileNotFoundError(f"no version {version} of {table}")
    return snapshots(spark, table, [at])[0]


def changed_folders(spark: SparkSession, table: str, since: int) -> list[str] | None:
    """Partition folders whose rows may differ between version ``since`` and now; None if that is not known.

    Upkeep moves rows and changes none, so what it wrote is left out. Versions that are gone leave a gap.
    """
    wanted = [v for v in versions(spark, table) if v >= since]
    if not wanted or wanted != list(range(since, wanted[-1] + 1)):
        return None
    history, changed = snapshots(spark, table, wanted), set()
    for old, new in zip(history, history[1:]):
        if new.partition_by != history[0].partition_by:
            return None
        if new.operation != UPKEEP:
            changed |= {f for f, v in new.folders.items() if old.folders.get(f) != v}
            changed |= set(old.folders) - set(new.folders)
    return sorted(changed)


def read_folders(
    spark: SparkSession, table: str, snap: Snapshot, folders: list[str] | None = None
) -> DataFrame:
    """Rows of a snapshot, or only of some of its partition folders.

    The schema is the recorded one, so no footer is read to find it, and files
    from before a column was added give NULL for it.
    """
    paths = snap.paths(table, folders)
    if not paths:
        return spark.createDataFrame([], snap.schema)
    reader = spark.read.schema(snap.schema).option("basePath", f"{table}/data")
    with few_listing_tasks(spark):
        rows = reader.parquet(*paths)
    return rows.select(*snap.schema.fieldNames())


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one given."""
    return read_folders(spark, table, snapshot(spark, table, version))


def _nullable(schema: StructType) -> StructType:
    out = StructType()
    for f in schema.fields:
        out = out.add(f.name, f.dataType, True)
    return out


def _written_folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    if not depth:
        return [""]
    found = files.matching(spark, root + "/" + "/".join(["*=*"] * depth))
    return ["/".join(p.split("/")[-depth:]) for p in found]


def _stage_version(
    df: DataFrame, table: str, partition_by: tuple[str, ...], spread: bool = True, placed: bool = False
) -> tuple[int, list[str], int | None]:
    """Write ``df`` as the next data version without making it visible; also its folders and rows.

    ``placed`` tells that ``df`` has the columns of ``with_folders`` already.
    """
    spark = df.sparkSession
    last = latest_version(spark, table)
    version = 0 if last is None else last + 1
    root = f"{table}/data/data_version={version}"
    folders = folder_columns(partition_by)
    out = df if placed else with_folders(df, partition_by)
    if partition_by and spread:
        # Rows of one partition meet in few tasks, so few files are written; adaptive
        # execution cuts a partition that is too big for one task into several.
        out = out.hint("rebalance", *folders)
    count = counted.row_counter()
    writer = count.on(out).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*folders)
    writer.parquet(root)
    return version, _written_folders(spark, root, len(partition_by)), count.figures().get("rows")


def _commit(
    spark: SparkSession,
    table: str,
    version: int,
    folders: dict[str, int],
    partition_by: tuple[str, ...],
    schema: StructType,
    operation: str,
    source_version: int | None,
    committed_at: datetime | None,
    packed: dict[int, str],
    rows: int | None,
) -> int:
    row = (
        folders,
        list(partition_by),
        _nullable(schema).json(),
        operation,
        source_version,
        packed,
        committed_at or datetime.now(timezone.utc),
    )
    target = f"{table}/snapshots/version={version}"
    spark.createDataFrame([row], _SNAPSHOT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(target)
    counted.mark(spark, target, rows)
    return version


def _kept_count(spark: SparkSession, table: str, version: int) -> int | None:
    return next(iter(counted.marked(spark, f"{table}/snapshots/version={version}").values()), None)


def rows(spark: SparkSession, table: str, version: int | None = None) -> int | None:
    """Rows of a version as counted when it was written; None if the table is not there."""
    at = latest_version(spark, table) if version is None else version
    if at is None:
        return None
    known = _kept_count(spark, table, at)
    return read(spark, table, at).count() if known is None else known


def overwrite(
    df: DataFrame,
    table: str,
    partition_by: tuple[str, ...] = (),
    operation: str = "overwrite",
    source_version: int | None = None,
    spread: bool = True,
    committed_at: datetime | None = None,
) -> int:
    """Make ``df`` the whole content of the table, schema included, as a new version."""
    version, folders, rows = _stage_version(df, table, tuple(partition_by), spread)
    return _commit(
        df.sparkSession,
        table,
        version,
        {f: version for f in folders},
        tuple(partition_by),
        df.schema,
        operation,
        source_version,
        committed_at,
        {},
        rows,
    )


def _partition_text(partition_by: tuple[str, ...]) -> Column:
    """A row's partition as its folder name has it; for string, integer and date columns.

    Spark writes the empty string to the folder of NULL.
    """
    texts = [c.cast("string") for c in folder_columns(partition_by).values()]
    values = [F.coalesce(F.when(t != "", t), F.lit(NULL_PARTITION)) for t in texts]
    return F.concat_ws("/", *values).alias(_IN)


def _folder_text(folder: str) -> str:
    return "/".join(unquote(part.split("=", 1)[1]) for part in folder.split("/"))


def merge(
    source: DataFrame,
    table: str,
    keys: list[str],
    update_if: str = "true",
    insert_if: str = "true",
    delete_if: str = "false",
    delete_unmatched_if: str = "false",
    source_version: int | None = None,
    operation: str = "merge",
    committed_at: datetime | None = None,
    evolve: bool = True,
) -> Merged:
    """Bring ``source`` into the table by key, as a new version; tells what it did.

    A source row that matches a row of the table deletes it if ``delete_if``, else replaces it if
    ``update_if``, else leaves it; one that matches nothing is added if ``insert_if``. Rows of the table that
    no source row matches go if ``delete_unmatched_if``. The conditions are SQL over ``s`` and ``t``, the rows of
    source and table; one that gives NULL does not hold. NULL keys match nothing. Columns of the source whose name
    starts with ``_merge`` serve the conditions and are not stored.

    A first join, of the keys and of what the conditions read, decides on every source row; if a key matches
    more than once, the merge is refused. Only partitions with a change are then read, once, and only they are
    written; those that lose or change rows are joined with the rows that tell so. Counts come with the decisions.
    """
    spark = source.sparkSession
    snap = snapshot(spark, table)
    helpers = [c for c in source.columns if c.startswith("_merge")]
    stored = enforce(source.drop(*helpers), snap.schema, evolve)
    columns = stored.columns
    # Rows of the source and of the table side by side; a missing side is NULL.
    by = snap.partition_by
    place = _partition_text(by) if by else F.lit("")
    ours = source.select(*keys, F.struct(*columns, *helpers).alias("s"), place.alias(_TO))

    def held(folders: list[str] | None = None) -> DataFrame:
        """The table, or some folders of it, with the columns the source adds."""
        there = read_folders(spark, table, snap, folders)
        new = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in columns if c not in there.columns]
        return there.select("*", *new)

    def theirs(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, F.struct(*columns).alias("t"), place.alias(_IN))

    def holds(condition: str) -> Column:
        return F.coalesce(F.expr(condition), F.lit(False))

    def picked(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{_quoted(c)}").alias(c) for c in columns])

    # The folder tells a match, so that of ``t`` only what the conditions read is joined.
    met = F.col(_IN).isNotNull()
    action = (
        F.when(met & holds(delete_if), _DELETE)
        .when(met & holds(update_if), _UPDATE)
        .when(~met & holds(insert_if), _INSERT)
        .otherwise(_KEEP)
    )
    joined = ours.join(theirs(held()), keys, "left").withColumn(_ACTION, action)
    decided = joined.select(picked("s").alias("s"), _ACTION, _IN, _TO)
    with staged(decided, "decided") as written:
        decisions = written.select(*[F.col(f"s.{_quoted(k)}").alias(k) for k in keys], "s", _ACTION, _IN, _TO)
        _refuse_ambiguous(decisions, keys)
        # One row per pair of partitions and action.
        done = decisions.where(F.col(_ACTION) != _KEEP).groupBy(_ACTION, _IN, _TO).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {a: sum(r["n"] for r in done if r[_ACTION] == a) for a in (_INSERT, _UPDATE, _DELETE)}
        losing = {r[_IN] for r in done if r[_ACTION] != _INSERT}
        places = losing | {r[_TO] for r in done if r[_ACTION] != _DELETE}
        purged = 0
        if delete_unmatched_if != "false":
            loose = theirs(held()).where(holds(delete_unmatched_if)).join(decisions.select(*keys), keys, "left_anti")
            found = {r[_IN]: r["n"] for r in loose.groupBy(_IN).agg(F.count(F.lit(1)).alias("n")).collect()}
            purged, losing, places = sum(found.values()), losing | set(found), places | set(found)
        if not places:
            version = snap.version
            if source_version not in (None, snap.source_version):
                version = _commit(
                    spark, table, version + 1, snap.folders, by, snap.schema, operation, source_version,
                    committed_at, snap.packed, _kept_count(spark, table, version),
                )
            return Merged(version, 0, 0, 0)
        rewritten = [f for f in snap.folders if not by or _folder_text(f) in places]
        # Only folders that lose or change rows are joined; the others and new rows go along as they are.
        touched = [f for f in rewritten if not by or _folder_text(f) in losing]
        tells = F.col(_ACTION).isin(_UPDATE, _DELETE)
        if delete_unmatched_if != "false":
            # A row that is matched and stays must not pass for an unmatched one.
            tells = tells | F.col(_IN).isNotNull()
        told = decisions.where(tells).select(*keys, "s", _ACTION)
        updated = F.coalesce(F.col(_ACTION) == _UPDATE, F.lit(False))
        unmatched = F.col(_ACTION).isNull() & ~holds(delete_unmatched_if)
        stays = unmatched | F.coalesce(F.col(_ACTION) == _KEEP, F.lit(False))
        both = theirs(held(touched)).join(told, keys, "left").where(updated | stays)
        inserts = written.where(F.col(_ACTION) == _INSERT).select("s.*")
        parts = [both.select(F.when(updated, F.col("s")).otherwise(F.col("t")).alias("_row")).select("_row.*")] if touched else []
        if len(touched) < len(rewritten):
            parts.append(held([f for f in rewritten if f not in touched]).select(*[F.col(_quoted(c)) for c in columns]))
        if counts[_INSERT]:
            # A table of one folder is not spread by folder when it is written.
            parts.append(inserts if by else inserts.hint("rebalance"))
        merged = reduce(DataFrame.unionByName, parts) if parts else held([]).select(*[F.col(_quoted(c)) for c in columns])
        gained = counts[_INSERT] - counts[_DELETE] - purged
        version = replace_folders(
            merged, table, snap, rewritten, operation, source_version, committed_at, spread=True, gained=gained
        )
    return Merged(version, counts[_INSERT], counts[_UPDATE], counts[_DELETE] + purged)


def _refuse_ambiguous(decided: DataFrame, keys: list[str]) -> None:
    # All rows of a key are met, or none.
    repeated = decided.where(F.col(_IN).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if not repeated.where("n > 1").isEmpty():
        raise DuplicateSourceKeys(f"rows repeat a key of the table: {', '.join(keys)}")


def upsert(
    updates: DataFrame,
    table: str,
    keys: list[str],
    source_version: int | None = None,
    operation: str = "upsert",
    committed_at: datetime | None = None,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
    evolve: bool = True,
) -> int:
    """Replace rows whose key is in ``updates``, add the others, as a new version.

    With ``resolve`` an update does not always win: it is given the updates together with
    the rows they match and returns the rows to keep, one for each key.

    NULL keys match nothing, so such rows are added. ``updates`` must have all columns of
    the table; new ones become part of it unless ``evolve`` is off. See ``merge``.
    """
    spark = updates.sparkSession
    if resolve is None:
        return merge(updates, table, keys, source_version=source_version, operation=operation, committed_at=committed_at, evolve=evolve).version
    snap = snapshot(spark, table)
    updates = enforce(updates, snap.schema, evolve)
    with staged(updates, "updates") as changes:
        rivals = read_folders(spark, table, snap).join(changes.select(*keys), keys, "left_semi")
        delivered = changes.withColumn(DELIVERED, F.lit(1))
        both = delivered.unionByName(rivals.withColumn(DELIVERED, F.lit(0)), allowMissingColumns=True)
        winners = resolve(both).drop(DELIVERED).select(*changes.columns)
        return merge(winners, table, keys, source_version=source_version, operation=operation, committed_at=committed_at, evolve=evolve).version


def replace_folders(
    df: DataFrame,
    table: str,
    snap: Snapshot,
    rewritten: list[str],
    operation: str,
    source_version: int | None = None,
    committed_at: datetime | None = None,
    spread: bool = False,
    packed_by: str | None = None,
    gained: int | None = None,
) -> int:
    """New version with the rows of ``df`` in place of some folders of ``snap``.

    Upkeep passes ``packed_by`` to mark what it wrote, so that it does not write it again; its rows come sorted by
    the columns of ``with_folders``. ``gained`` is by how many rows the table grows, if the caller knows.
    """
    upkeep = packed_by is not None
    before = _kept_count(df.sparkSession, table, snap.version)
    version, written, _ = _stage_version(df, table, snap.partition_by, spread, placed=upkeep)
    gone = set(rewritten)
    lost = [f for f in written if f in snap.folders and f not in gone]
    if lost:
        raise RuntimeError(f"folders would lose their rows, none is replaced: {lost[:3]}")
    folders = {f: v for f, v in snap.folders.items() if f not in gone}
    folders.update({f: version for f in written})
    packed = {v: c for v, c in snap.packed.items() if v in folders.values()}
    if upkeep:
        packed[version] = packed_by
    return _commit(
        df.sparkSession,
        table,
        version,
        folders,
        snap.partition_by,
        snap.schema if upkeep else df.schema,
        operation,
        snap.source_version if source_version is None else source_version,
        committed_at,
        packed,
        counted.total([before, gained]),
    )


def write_or_upsert(
    df: DataFrame,
    table: str,
    keys: list[str],
    partition_by: tuple[str, ...] = (),
    source_version: int | None = None,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """First run writes the table, later runs upsert into it."""
    if latest_version(df.sparkSession, table) is None:
        return overwrite(df, table, partition_by, "initial write", source_version)
    return upsert(df, table, keys, source_version, resolve=resolve)
