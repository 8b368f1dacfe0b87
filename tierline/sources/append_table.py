"""Append-only tables: plain parquet, one partition folder per append.

    <table>/ingest_version=<n>/batch_key=<key>/part-*.parquet

``batch_key`` names the batch, so that a batch delivered twice never adds rows. A
folder counts once Spark has put ``_SUCCESS`` in it, so a failed or running append is
not read. A batch that was replaced stays, unread, until ``drop_replaced``: what was built
from it must learn which rows it held. One writer per table at a time.
"""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tierline.schemas import enforce
from tierline.sources import counted, files
from tierline.sources.settings import few_listing_tasks

VERSION = "ingest_version"
KEY = "batch_key"
_FOLDER = re.compile(rf"{VERSION}=(\d+)/{KEY}=([^/]+)")


class Append(NamedTuple):
    version: int
    key: str
    path: str


def _appends(spark: SparkSession, table: str, pattern: str) -> list[Append]:
    found = []
    for path in files.matching(spark, f"{table}/{VERSION}=*/{KEY}=*{pattern}"):
        hit = _FOLDER.search(path)
        if hit:
            folder = path[: len(path) - len(pattern)]
            found.append(Append(int(hit[1]), hit[2], folder))
    return sorted(found)


def _newest(done: list[Append]) -> list[Append]:
    return sorted({a.key: a for a in done}.values())


def committed(spark: SparkSession, table: str) -> list[Append]:
    """The finished batches; of one that was replaced, the newest."""
    return _newest(_appends(spark, table, "/_SUCCESS"))


def replaced(spark: SparkSession, table: str, upto: int | None = None) -> list[Append]:
    """Finished batches that newer ones of their key stand in for; ``upto`` a version of their own."""
    done = _appends(spark, table, "/_SUCCESS")
    now = set(_newest(done))
    return [a for a in done if a not in now and (upto is None or a.version <= upto)]


def drop_replaced(spark: SparkSession, table: str, upto: int | None = None) -> None:
    """Delete replaced batches, once nothing needs to know what they held."""
    for a in replaced(spark, table, upto):
        files.delete(spark, a.path)


def counts(spark: SparkSession, table: str) -> dict[Append, int]:
    """Rows of each committed batch as counted when it was written; only one without a count is read."""
    known = counted.marked(spark, f"{table}/{VERSION}=*/{KEY}=*")
    return {
        a: known[a.path] if a.path in known else read_batches(spark, table, [a]).count()
        for a in committed(spark, table)
    }


def rows(spark: SparkSession, table: str) -> int | None:
    """Rows of all committed batches, without reading them; None if there is no batch."""
    per_batch = counts(spark, table)
    return sum(per_batch.values()) if per_batch else None


def latest_version(spark: SparkSession, table: str) -> int | None:
    done = committed(spark, table)
    return done[-1].version if done else None


def append(
    df: DataFrame,
    table: str,
    batch_key: str | None = None,
    keep: bool = False,
    evolve: bool = True,
) -> int:
    """Add ``df`` as one batch and return its version.

    Without a ``batch_key`` every call is a new batch. With one, a batch that is there
    already is replaced, or left as it is with ``keep``. A replacement is written beside the
    old batch under a new version and counts once it is finished, so a failed attempt loses
    nothing and readers that follow versions see it. Columns the table does not have are
    refused unless ``evolve`` is set.
    """
    spark = df.sparkSession
    key = batch_key or f"batch-{uuid.uuid4().hex}"
    if not re.fullmatch(r"[A-Za-z0-9._-]+", key):
        raise ValueError(f"batch key {key!r} may hold letters, digits, dot, dash and underscore")
    finished = _appends(spark, table, "/_SUCCESS")
    done = _newest(finished)
    if done and not evolve:
        df = enforce(df, read(spark, table).drop(VERSION, KEY).schema)
    same = [a for a in done if a.key == key]
    if same and keep:
        return same[0].version
    started = _appends(spark, table, "")
    version = max((a.version for a in started), default=-1) + 1
    folder = f"{table}/{VERSION}={version}/{KEY}={key}"
    count = counted.row_counter()
    count.on(df).write.mode("overwrite").parquet(folder)
    counted.mark(spark, folder, count.figures().get("rows"))
    # What failed attempts left goes.
    for a in set(started) - set(finished):
        if a.key == key and a.version != version:
            files.delete(spark, a.path)
    return version


def read(
    spark: SparkSession,
    table: str,
    as_of: int | None = None,
    after: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Committed rows with ``ingest_version`` and ``batch_key`` columns.

    ``as_of`` reads the table, schema included, as it was at that version, as long as the batches
    replaced since have not been dropped; ``after`` leaves out versions up to and including the one
    given. Unless ``schema`` is given, the schemas of all batches are merged, which reads the
    footers of their files.
    """
    then = [a for a in _appends(spark, table, "/_SUCCESS") if as_of is None or a.version <= as_of]
    done = [a for a in _newest(then) if after is None or a.version > after]
    if not done:
        raise FileNotFoundError(f"no committed batch in {table} for as_of={as_of} after={after}")
    return read_batches(spark, table, done, schema)


def read_batches(
    spark: SparkSession, table: str, done: list[Append], schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.option("basePath", table)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    with few_listing_tasks(spark):
        return reader.parquet(*[a.path for a in done])
