"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tierline.sources import files
from tierline.sources.counted import Counted


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tierline-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``.

    Every executor must see the folder, so a machine-local one is used only by a
    local session that names none.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder(context.applicationId)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def staged(df: DataFrame, label: str, counted: Counted | None = None) -> Iterator:
    """``df`` written once to the shared folder and read back, for several jobs.

    Later readers take only the columns they select, and a lost executor costs a
    file read, not a recomputation. The copy is deleted at the end of the block. With
    ``counted`` the block gets the frame and the figures the write counted.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    (df if counted is None else counted.on(df)).write.parquet(path)
    try:
        back = spark.read.schema(df.schema).parquet(path)
        yield back if counted is None else (back, counted.figures())
    finally:
        files.delete(spark, path)
