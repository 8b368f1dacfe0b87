"""What several operators of this package share: words and shingles, ranges of ids, joined classes."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.scratch import scratch_dir

SHINGLE = 5
WORD = re.compile(r"\w+")
#: Text taken at once inside a task, in code points; a longer text is taken alone.
CHUNK_CHARS = 2_000_000
#: Words whose hash a worker keeps between batches. Only speed depends on it.
KEPT_WORDS = 300_000


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not on their path."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir`` and read from there."""
    context: SparkContext = df.sparkSession.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: later reads take only the columns they need."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """``df``, to be broadcast if it has at most ``rows`` rows; beyond, Spark joins as it sees fit."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bits of a filter for each of its entries, so that at most one number in twenty passes by chance.
FILTER_SHARE = 20
#: A filter is broadcast up to this many bits, 128 MB for 53 million entries; beyond, numbers are joined.
FILTER_MOST = 1 << 30
_ROW_BITS = 32768


@dataclass(frozen=True)
class Filter:
    """A set of 64-bit numbers: rows (_row, _bits) of a bitmap, or, with no ``bits``, the numbers (_h) themselves."""

    table: DataFrame
    bits: int


def bitmap(hashes: DataFrame, most: int = FILTER_MOST) -> Filter:
    """The filter that holds all numbers of the only column of ``hashes``; its size follows from their count."""
    numbers = stored(hashes.toDF("_h").where("_h is not null").distinct(), "filter")
    bits = max(_ROW_BITS, 1 << (FILTER_SHARE * max(1, numbers.count()) - 1).bit_length())
    if bits > most:
        return Filter(numbers, 0)
    at = numbers.select(F.pmod("_h", F.lit(bits)).alias("_bit")).groupBy(F.expr(f"_bit div {_ROW_BITS}").alias("_row"))
    return Filter(checkpointed(at.agg(F.expr(f"bitmap_construct_agg(_bit % {_ROW_BITS})").alias("_bits"))), bits)


def in_bitmap(df: DataFrame, held: Filter, number: str, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false only if the filter does not hold ``number``.

    A bitmap is broadcast. A set too large for that is joined by shuffling ``df``, and ``out`` is exact.
    """
    if not held.bits:
        known = held.table.select("_h", F.lit(True).alias("_known"))
        joined = df.join(known, F.col(number) == F.col("_h"), "left")
        return joined.withColumn(out, F.coalesce("_known", F.lit(False))).drop("_h", "_known")
    at = df.withColumn("_bit", F.pmod(number, F.lit(held.bits)))
    at = at.withColumn("_row", F.expr(f"_bit div {_ROW_BITS}"))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast((_bit % {_ROW_BITS}) div 8 + 1 as int), 1)")), 16, 10)
    joined = at.join(F.broadcast(held.table), "_row", "left").withColumn("_byte", F.coalesce(byte, F.lit("0")).cast("int"))
    hit = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1")
    return joined.withColumn(out, hit).drop("_row", "_bit", "_bits", "_byte")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_ranges(df: DataFrame, key: str, parts: int) -> DataFrame:
    """``df`` with an int column ``_range`` from 0 to ``parts`` - 1 that grows with ``key``, nulls first.

    The bounds are quantiles of all rows, so ranges hold about equal numbers of rows.
    """
    number = F.coalesce(F.col(key).cast("double"), F.lit(float("-inf")))
    at = [i / parts for i in range(1, parts)]
    cuts = df.select(number.alias("_n")).approxQuantile("_n", at, 1 / (4 * parts)) if at else []
    inner = sorted({c for c in cuts if c != float("-inf")})
    if not inner:
        return df.withColumn("_range", F.lit(0))
    # Only the driver needs it; it would take 40 MB of each worker that imports this module.
    from pyspark.ml.feature import Bucketizer

    splits = [float("-inf"), *inner, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_n", outputCol="_cut").transform(df.withColumn("_n", number))
    return cut.withColumn("_range", F.col("_cut").cast("int")).drop("_n", "_cut")


def slices(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[slice]:
    """Runs of texts of at most ``most`` code points together."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


def words(text: str) -> list[str]:
    """Runs of letters, digits and underscores, in lower case."""
    return WORD.findall(text.lower())


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words of all texts, and the number of words of each text."""
    if len(_hashes) > KEPT_WORDS:
        _hashes.clear()
    lists = [words(t) for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(lists)), np.uint64, int(counts.sum()))
    return flat, counts


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(flat: np.ndarray, counts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, text by text, and their number in each text.

    A text of fewer words, but at least one, has one shingle of all its words.
    """
    per_text = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    begin = np.repeat(first - np.concatenate(([0], np.cumsum(per_text)))[:-1], per_text) + np.arange(per_text.sum())
    last = np.repeat(first + counts, per_text)
    padded = np.concatenate((flat, np.zeros(size, np.uint64)))
    h = np.zeros(len(begin), np.uint64)
    for j in range(size):
        inside = begin + j < last
        h = np.where(inside, mixed(h * np.uint64(0x9E3779B97F4A7C15) + padded[begin + j]), h)
    return h, per_text


#: How to let go of what a worker keeps between the tasks of an operator, by the module that keeps it.
_KEPT: dict[str, Callable[[], None]] = {__name__: _hashes.clear}
_at_work = ""


def kept_by(module: str, let_go: Callable[[], None]) -> None:
    _KEPT[module] = let_go


def begin(module: str) -> None:
    """A worker serves one operator after another; what it kept for the one before goes."""
    global _at_work
    if module != _at_work:
        for other, let_go in _KEPT.items():
            if other != module:
                let_go()
        _at_work = module
        give_back()


def give_back() -> None:
    """What a task has freed goes back to the system; else a waiting worker would hold its largest batch's memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def arrow_map(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    ship(df.sparkSession)
    module = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(module)
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def arrow_groups(df: DataFrame, key: str, fn: Callable[[pa.Table], pa.Table], schema: str | T.StructType) -> DataFrame:
    """``fn`` of all rows of each ``key``."""
    ship(df.sparkSession)
    module = fn.__module__

    def run(table: pa.Table) -> pa.Table:
        begin(module)
        try:
            return fn(table)
        finally:
            give_back()

    return df.groupBy(key).applyInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id in ``links`` (a, b): root is the smallest id that links lead to.

    Alternates large-star and small-star steps. Each step keeps one row for a node and its
    neighbour, so no group is gathered; links to one hot node are reduced by partial minima.
    """
    edges = checkpointed(links.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct())
    before: tuple | None = None
    while True:
        for large in (True, False):
            both = edges.union(edges.select("b", "a")) if large else edges
            low = both.groupBy("a").agg(F.min("b").alias("low"))
            low = low.withColumn("low", F.least("low", "a"))
            joined = both.join(low, "a")
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")) if large else (
                joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
            )
            edges = moved.where("a <> b").distinct()
        edges = checkpointed(edges)
        state = tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0)))")).first())
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )
