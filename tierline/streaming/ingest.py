"""Raw files as a stream into the Bronze table that batches use as well."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tierline.schemas import RAW_TRANSACTIONS
from tierline.sources import append_table
from tierline.sources.csv_feed import with_lineage

# Fixed value: pause between micro-batches of a continuous stream.
CONTINUOUS_INTERVAL = "30 seconds"


def raw_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded frame over the ``*.csv`` files that appear in a folder."""
    reader = (
        spark.readStream.option("header", True)
        .option("pathGlobFilter", "*.csv")
        .schema(RAW_TRANSACTIONS)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_lineage(reader.csv(folder))


def _bronze_writer(checkpoint: str, bronze: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # Spark keeps one id per checkpoint. With it, a batch delivered again after a
        # failure is added once, and a new checkpoint never meets an old batch.
        stream = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        append_table.append(batch, bronze, f"stream-{stream}-{batch_id}", keep=True)

    return write


def start(stream: DataFrame, bronze: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start appending to Bronze and return the running query.

    ``once`` takes what is there and stops; otherwise a batch runs every 30 seconds until
    the caller stops the query.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_bronze_writer(checkpoint, bronze))
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=CONTINUOUS_INTERVAL).start()


def ingest_available(
    spark: SparkSession,
    folder: str,
    bronze: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> int:
    """Drain the folder into Bronze; returns the rows Bronze holds afterwards."""
    return drain(spark, folder, bronze, checkpoint, max_files_per_trigger).held


class Drained(NamedTuple):
    """What a run of the stream did, as counted by its own writes."""

    batches: int
    taken: int
    held: int


def drain(
    spark: SparkSession,
    folder: str,
    bronze: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> Drained:
    """Drain the folder into Bronze; tells batches and rows this run added, and the rows Bronze holds.

    A micro-batch that was written by an earlier run, and is only delivered again, adds nothing and is not
    told. No row of Bronze is read for the counts.
    """
    before = append_table.counts(spark, bronze)
    start(raw_stream(spark, folder, max_files_per_trigger), bronze, checkpoint).awaitTermination()
    after = append_table.counts(spark, bronze)
    added = {batch: n for batch, n in after.items() if batch not in before}
    return Drained(len(added), sum(added.values()), sum(after.values()))
