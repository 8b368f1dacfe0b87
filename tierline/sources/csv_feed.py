"""Raw transaction files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.schemas import RAW_TRANSACTIONS
from tierline.sources import files


def read_raw_csv(spark: SparkSession, source: str, check_header: bool = False) -> DataFrame:
    """Raw rows as strings, under the fixed schema; types are never inferred.

    In a folder only ``*.csv`` files are read. The schema goes by position, so an
    unexpected column is ignored; with ``check_header`` a header that differs from
    the schema fails the read.
    """
    if not files.exists(spark, source):
        raise FileNotFoundError(f"no raw files at {source}")
    reader = spark.read.option("header", True).schema(RAW_TRANSACTIONS)
    if check_header:
        reader = reader.option("enforceSchema", False)
    if files.is_folder(spark, source):
        reader = reader.option("pathGlobFilter", "*.csv")
    return reader.csv(source)


def with_lineage(df: DataFrame, source_hint: str | None = None) -> DataFrame:
    """Add the file each row came from, the ingest time and, for batches, a hint."""
    out = df.select("*", F.col("_metadata.file_path").alias("_source_file"))
    if source_hint is not None:
        out = out.withColumn("_source_hint", F.lit(source_hint))
    return out.withColumn("_ingest_ts", F.current_timestamp())
