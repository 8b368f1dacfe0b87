"""Row counts taken by the job that writes, and kept beside what it wrote.

A count is an empty file ``_rows-<n>`` in the folder it belongs to, so a folder listing tells how many rows a table
holds and no data is read again. A folder without one, written by others or cut off just then, is counted by reading.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline.sources import files

_ROWS = "_rows-"
_MARK = re.compile(rf"^(.*)/{_ROWS}(\d+)$")


class Counted:
    """Figures of a frame, filled in by the one job that writes it.

    Put it on a frame after its last shuffle: the tasks that write then count, and of a task that runs twice one
    result is taken. Ahead of a shuffle, a stage that is run again for a lost executor would count twice.
    """

    def __init__(self, **figures: Column) -> None:
        self._figures = figures
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[c.alias(name) for name, c in self._figures.items()])

    def figures(self) -> dict[str, int]:
        """Waits for the job; a figure the optimizer found nothing to count for is left out."""
        return {k: v for k, v in self._seen.get.items() if v is not None}


def row_counter() -> Counted:
    return Counted(rows=F.count(F.lit(1)))


def mark(spark: SparkSession, folder: str, rows: int | None) -> None:
    """Keep the count of a finished folder; None leaves it to be read."""
    if rows is not None:
        files.touch(spark, f"{folder}/{_ROWS}{rows}")


def marked(spark: SparkSession, pattern: str) -> dict[str, int]:
    """The kept count of each folder that matches, by the folder's path."""
    found = (_MARK.match(p) for p in files.matching(spark, f"{pattern}/{_ROWS}*"))
    return {hit[1]: int(hit[2]) for hit in found if hit}


def total(counts: Sequence[int | None]) -> int | None:
    """The sum, or None if one of them is not known."""
    return None if any(c is None for c in counts) else sum(counts)
