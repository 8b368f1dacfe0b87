"""Vectors in blocks: packed by column, and every block of queries met by every block of candidates.

A block is one row that holds some thousand vectors as a matrix of whole numbers, one dimension after the other. The
queries are laid out over stripes of candidates like a grid: a cell is one block of queries and one stripe, whose
blocks stream past the queries one by one. Cells are dealt out by number, so no cell waits for another, and a task
holds one block of queries and a few blocks of candidates at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import arrow_map, shuffle_width, stored

#: Vectors of a block of candidates and of a block of queries, and numbers of a block at most.
CANDIDATE_ROWS = 4096
QUERY_ROWS = 16384
BLOCK_NUMBERS = 1 << 22
#: Bytes of candidates in a stripe, and stripes at least.
STRIPE_BYTES = 32 << 20
LEAST_STRIPES = 16
#: Tasks of a grid at most, if the session does not ask for more.
MOST_TASKS = 4096
#: Stands for a null id inside blocks: behind all others in every order. An id of this value is taken for null.
NO_ID = np.iinfo(np.int64).max

_PACKED = "rows INT, dims INT, kind STRING, ids BINARY, labels BINARY, numbers BINARY"


class Block(NamedTuple):
    """Vectors by column: ``numbers`` has a row for each dimension."""

    ids: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray
    largest: np.ndarray  # of each dimension, the largest absolute value


def _row(ids: list[np.ndarray], labels: list[np.ndarray], vectors: list[np.ndarray]) -> list:
    """Blocks of equally long vectors come as matrices already; others are filled up with zeros."""
    dims = max((v.shape[0] for v in vectors), default=0)
    full = [np.vstack([v, np.zeros((dims - v.shape[0], v.shape[1]))]) if v.shape[0] < dims else v for v in vectors]
    numbers = np.hstack(full)
    top = np.abs(numbers).max(initial=0)
    if top >= 2.0**63:
        raise OverflowError(f"a component of {top:.3g} after scaling does not fit in a long")
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8"
    return [
        numbers.shape[1], dims, kind, np.concatenate(ids).astype("<i8").tobytes(),
        np.concatenate(labels).astype("<i8").tobytes(), numbers.astype(kind).tobytes(),
    ]


def packed(df: DataFrame, key: str, vector: str, scale: float, label: str | None = None, rows: int = CANDIDATE_ROWS) -> DataFrame:
    """Blocks of ``floor(scale * x)`` for all components x, multiplied as doubles.

    Rows whose vector is null or holds null or non-finite components are left out. Vectors shorter than others of
    their block are filled up with zeros, which adds nothing to an inner product. A block comes from one partition.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            row = _row(ids, labels, vectors)
            arrays = [pa.array([v], t) for v, t in zip(row, _ARROW)]
            return pa.RecordBatch.from_arrays(arrays, _NAMES)

        for batch in batches:
            column = batch.column("_vector")
            batch = batch.filter(column.is_valid())
            column = batch.column("_vector")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            # Nulls become NaN here.
            flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            bad = np.zeros(len(lengths), bool)
            bad[owner[~np.isfinite(flat)]] = True
            first = np.cumsum(lengths) - lengths
            key_ = batch.column("_id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
            label_ = batch.column("_label").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for dims in np.unique(lengths):
                of = np.flatnonzero(~bad & (lengths == dims))
                most = max(1, min(rows, BLOCK_NUMBERS // max(1, int(dims))))
                while len(of):
                    if held >= most:
                        yield out()
                        ids, labels, vectors, held = [], [], [], 0
                    take, of = of[: most - held], of[most - held :]
                    at = first[take][None, :] + np.arange(dims)[:, None]
                    vectors.append(np.floor(flat[at] * scale) if dims else np.zeros((0, len(take))))
                    ids.append(key_[take])
                    labels.append(label_[take])
                    held += len(take)
        if held:
            yield out()

    chosen = df.select(
        df[f"`{key}`"].cast("bigint").alias("_id"),
        df[f"`{vector}`"].alias("_vector"),
        (F.lit(0) if label is None else df[f"`{label}`"]).cast("bigint").alias("_label"),
    )
    return arrow_map(chosen, blocks, _PACKED)


_ARROW = [pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
_NAMES = ["rows", "dims", "kind", "ids", "labels", "numbers"]


def opened(row: dict) -> Block:
    numbers = np.frombuffer(row["numbers"], row["kind"]).reshape(row["dims"], row["rows"])
    largest = np.abs(numbers.astype(np.float64)).max(axis=1, initial=0)
    return Block(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), numbers, largest)


def exact_type(a: Block, b: Block) -> type:
    """A type in which inner products of both blocks, and all their partial sums, are exact."""
    n = min(len(a.largest), len(b.largest))
    bound = float(a.largest[:n] @ b.largest[:n])
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object


def as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and any(not -(2**63) <= s < 2**63 for s in scores.flat):
        raise OverflowError("an inner product does not fit in a long")
    return scores.astype(np.int64)


def candidate_blocks(df: DataFrame, key: str, vector: str, scale: float, label: str | None = None) -> DataFrame:
    """The packed candidates as a table, with a number ``block`` that stays."""
    blocks = packed(df, key, vector, scale, label).withColumn("block", F.monotonically_increasing_id())
    return stored(blocks, "vector-blocks")


def query_blocks(df: DataFrame, key: str, vector: str, scale: float, label: str | None = None) -> DataFrame:
    """The packed queries as a table; ``q`` numbers the blocks without gaps but for empty ones."""
    df = df.select(*[df[f"`{c}`"] for c in dict.fromkeys([key, vector, *([label] if label else [])])])
    dims = df.agg(F.max(F.size(vector))).first()[0] or 1
    rows = max(1, min(QUERY_ROWS, BLOCK_NUMBERS // max(dims, 1)))
    parts = max(1, math.ceil(df.count() / rows))
    # Dealt out in turns, a partition holds no more than a block.
    whole = packed(df.repartition(parts), key, vector, scale, label, rows=2 * rows)
    return stored(whole.withColumn("q", F.spark_partition_id().cast("bigint")), "query-blocks")


class Grid(NamedTuple):
    """Cells of (block of queries, stripe of candidates), to be streamed by ``over``."""

    queries: DataFrame
    candidates: DataFrame

    def over(self, meet: Callable[[Iterator[dict]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """``meet`` is given the rows of a task: for each cell, the block of queries and then the candidates' blocks.

        Rows are dicts of block columns with ``q``, ``stripe`` and ``is_query``; ``queries`` may have more columns.
        """
        spark = self.queries.sparkSession
        n_queries = (self.queries.agg(F.max("q")).first()[0] or 0) + 1
        blocks, size = self.candidates.agg(F.count("*"), F.sum(F.length("numbers"))).first()
        stripes = max(1, min(blocks, max(LEAST_STRIPES, math.ceil((size or 0) / STRIPE_BYTES))))
        tasks = min(n_queries * stripes, max(shuffle_width(spark), MOST_TASKS))
        # Blocks of one partition follow each other in number, so they go round the stripes.
        stripe = F.pmod(F.shiftright("block", 33) + F.col("block").bitwiseAND((1 << 33) - 1), F.lit(stripes))
        left = self.queries.withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(stripes - 1).cast("bigint"))))
        right = self.candidates.withColumn("stripe", stripe.cast("bigint")).withColumn(
            "q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_queries - 1).cast("bigint")))
        )
        cells = left.withColumn("is_query", F.lit(True)).unionByName(right.withColumn("is_query", F.lit(False)), allowMissingColumns=True)
        cell = F.pmod(F.col("q") * stripes + F.col("stripe"), F.lit(tasks)).cast("int")
        dealt = cells.repartitionById(tasks, cell)
        ordered = dealt.sortWithinPartitions("q", "stripe", F.col("is_query").desc(), "block")

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}

        return arrow_map(ordered, lambda batches: meet(rows(batches)), schema)
