"""Raw CSV files whose header differs from file to file.

The headers are read in one Spark job, files with the same header are read together under the columns it names,
and the groups are united by name. So columns may come in any order, unknown ones are kept as text, and a column that a
file does not have is NULL in its rows.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.schemas import BRONZE_TRANSACTIONS, RAW_TRANSACTIONS, SchemaMismatch
from tierline.sources import append_table, files
from tierline.sources.csv_feed import with_lineage
from tierline.sources.settings import one_file_a_task

#: Names that Bronze adds to the raw columns; a file may not bring them.
_TAKEN = {f.name for f in BRONZE_TRANSACTIONS} - set(RAW_TRANSACTIONS.names) | {append_table.VERSION, append_table.KEY}


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank of the file a task reads; the rest of the file is not asked for."""
    for batch in batches:
        filled = pc.not_equal(pc.utf8_trim_whitespace(batch.column("header")), "")
        lines = batch.filter(filled)
        if lines.num_rows:
            yield lines.slice(0, 1)
            return


def headers(spark: SparkSession, source: str) -> DataFrame:
    """Rows (file, header): the first line of each CSV file of a folder, or of one file. Files without a line have no row.

    One task reads a file, and stops after its first batch of lines. Lazy; collect it under ``one_file_a_task``.
    """
    reader = spark.read
    if files.is_folder(spark, source):
        reader = reader.option("pathGlobFilter", "*.csv")
    lines = reader.text(source).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"))
    return lines.mapInArrow(_first_lines, "file string, header string")


def columns_of(header: str, known: StructType = RAW_TRANSACTIONS) -> list[str]:
    """The column names of a header line, trimmed, known ones in the spelling of the contract.

    A column without a name is called by its place, ``_c0`` being the first. Raises if names repeat, are taken
    by Bronze, or a required column is not there.
    """
    spelt = {n.lower(): n for n in known.names}
    given = [name.strip() or f"_c{i}" for i, name in enumerate(next(csv.reader([header])))]
    names = [spelt.get(n.lower(), n) for n in given]
    folded = [n.lower() for n in names]
    problems = [f"column {n} occurs twice" for i, n in enumerate(names) if n.lower() in folded[:i]]
    problems += [f"column {n} is not for raw files" for n in names if n.lower() in _TAKEN]
    problems += [f"missing column {f.name}" for f in known if not f.nullable and f.name.lower() not in folded]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return names


def header_groups(spark: SparkSession, source: str) -> dict[tuple[str, ...], list[str]]:
    """The files of each list of columns. Only names of files and columns come to the driver.

    Unknown columns that differ in case alone take the spelling of the first file that has them.
    """
    if not files.exists(spark, source):
        raise FileNotFoundError(f"no raw files at {source}")
    with one_file_a_task(spark):
        found = sorted(tuple(r) for r in headers(spark, source).collect())
    if not found:
        raise FileNotFoundError(f"no line in any raw file at {source}")
    spelt: dict[str, str] = {}
    groups = defaultdict(list)
    for file, header in found:
        try:
            names = columns_of(header)
        except SchemaMismatch as error:
            raise SchemaMismatch(f"{file}: {error}") from None
        groups[tuple(spelt.setdefault(n.lower(), n) for n in names)].append(file)
    return dict(groups)


def read_changing_csv(spark: SparkSession, source: str, source_hint: str | None = None) -> DataFrame:
    """All rows as strings with their lineage: the columns of the contract, then unknown ones by name.

    Each group of files is one scan; a file is read once more than its first lines.
    """
    groups = header_groups(spark, source)

    def rows(names: tuple[str, ...], paths: list[str]) -> DataFrame:
        schema = StructType([StructField(n, StringType()) for n in names])
        return with_lineage(spark.read.option("header", True).schema(schema).csv(paths), source_hint)

    united = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows(n, p) for n, p in groups.items()]
    )
    for name in RAW_TRANSACTIONS.names:
        if name not in united.columns:
            united = united.withColumn(name, F.lit(None).cast("string"))
    lineage = [f.name for f in BRONZE_TRANSACTIONS if f.name in _TAKEN and f.name in united.columns]
    more = sorted(set(united.columns) - set(RAW_TRANSACTIONS.names) - set(lineage))
    quoted = ["`" + n.replace("`", "``") + "`" for n in [*RAW_TRANSACTIONS.names, *more, *lineage]]
    return united.select(*quoted)
