"""Session settings held for the length of one read or write."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Enough to list thousands of folders side by side, whatever the cluster has at the moment.
LISTING_TASKS = 64


@contextmanager
def _held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_listing_tasks(spark: SparkSession):
    """List folders in at most LISTING_TASKS tasks; by default each folder is a task of its own."""
    limit = int(spark.conf.get(_LISTING_TASKS))
    return _held(spark, _LISTING_TASKS, str(min(limit, LISTING_TASKS)))


_TASK_BYTES, _OPEN_BYTES = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@contextmanager
def one_file_a_task(spark: SparkSession) -> Iterator[None]:
    """Scans that run meanwhile neither split a file nor read two of them in one task."""
    beyond = str(1 << 50)
    with _held(spark, _TASK_BYTES, beyond), _held(spark, _OPEN_BYTES, beyond):
        yield
