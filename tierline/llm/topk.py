"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie dimension by dimension. For a tile of queries and candidates the products are added up block of
dimensions by block of dimensions. After each block, what the remaining dimensions can still add is at most the
product of the lengths of both rests (Cauchy-Schwarz). A pair whose sum and bound stay below the k-th best score
of its query is given up, and once few pairs are left they are compacted into a list and only they go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierline.llm.vector_blocks import NO_ID, Block, Grid, as_long, candidate_blocks, exact_type, opened, query_blocks

#: Queries and candidates of a tile.
TILE = 256, 1024
#: Blocks of dimensions of a vector, each of this many dimensions at least.
STEPS = 8
LEAST_STEP = 8
#: Below this share of pairs left, they go on as a list.
SPARSE = 0.2

FOUND = "q BIGINT, slot BIGINT, query_id BIGINT, own_score BIGINT, vec_id BIGINT, score BIGINT"


def cuts(dims: int) -> list[tuple[int, int]]:
    """The blocks of dimensions."""
    step = max(LEAST_STEP, -(-dims // STEPS))
    return [(a, min(a + step, dims)) for a in range(0, dims, step)]


def rests(numbers: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Of each vector, behind each block of dimensions: the length of what remains, rounded up."""
    squares = np.array([np.square(numbers[a:b].astype(np.float64)).sum(axis=0) for a, b in steps])
    return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1] - squares) * (1 + 1e-5) + 1e-3


class Best:
    """The best candidates of each query of a block so far, best first; ties by the smaller id."""

    def __init__(self, queries: Block, k: int, same_label: bool) -> None:
        n = len(queries.ids)
        self.queries, self.k, self.same_label = queries, k, same_label
        self.scores = np.zeros((n, k), np.int64)
        self.ids = np.full((n, k), NO_ID, np.int64)
        self.filled = np.zeros(n, np.int64)
        # Dimensions that weigh most in the queries come first, so that bounds fall soon.
        self.order = np.argsort(-np.square(queries.numbers.astype(np.float64)).sum(axis=1), kind="stable")
        self.steps = cuts(len(self.order))
        self.rests = rests(queries.numbers[self.order], self.steps)

    def _floor(self, part: slice) -> np.ndarray:
        """The score a candidate must reach."""
        return np.where(self.filled[part] == self.k, self.scores[part, -1].astype(np.float64), -np.inf)

    def _add(self, part: slice, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        n = part.stop - part.start
        held = np.arange(self.k)[None, :] < self.filled[part, None]
        who = np.concatenate([np.nonzero(held)[0], query])
        ids = np.concatenate([self.ids[part][held], ids])
        scores = np.concatenate([self.scores[part][held], scores])
        order = np.lexsort((ids, ~scores, who))
        who, ids, scores = who[order], ids[order], scores[order]
        rank = np.arange(len(who)) - np.searchsorted(who, np.arange(n))[who]
        keep = rank < self.k
        at = who[keep] + part.start, rank[keep]
        self.ids[at], self.scores[at] = ids[keep], scores[keep]
        self.filled[part] = np.minimum(np.bincount(who, minlength=n), self.k)

    def meet(self, candidates: Block) -> None:
        exact = exact_type(self.queries, candidates)
        dims = len(self.order)
        numbers = np.zeros((dims, len(candidates.ids)), exact)
        both = min(dims, len(candidates.numbers))
        numbers[:both] = candidates.numbers[:both]
        mine, theirs = self.queries.numbers[self.order].astype(exact), numbers[self.order]
        length = rests(theirs, self.steps) if exact is not object else None
        for a in range(0, len(self.queries.ids), TILE[0]):
            part = slice(a, min(a + TILE[0], len(self.queries.ids)))
            for c in range(0, len(candidates.ids), TILE[1]):
                of = slice(c, min(c + TILE[1], len(candidates.ids)))
                allowed = True
                if self.same_label:
                    allowed = self.queries.labels[part, None] == candidates.labels[None, of]
                if exact is object:
                    scores = as_long(np.asarray(mine[:, part].T @ theirs[:, of]).reshape(part.stop - a, -1))
                    query, row = np.nonzero(np.broadcast_to(allowed, scores.shape))
                    self._add(part, query, candidates.ids[of][row], scores[query, row])
                    continue
                query, row, scores = self._survivors(part, mine[:, part], theirs[:, of], length[:, of], allowed)
                if len(query):
                    self._add(part, query, candidates.ids[of][row], as_long(scores))

    def _survivors(
        self, part: slice, mine: np.ndarray, theirs: np.ndarray, length: np.ndarray, allowed: np.ndarray | bool
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of pairs of a tile that may be among the best."""
        floor = self._floor(part)
        total = np.zeros((mine.shape[1], theirs.shape[1]), mine.dtype)
        keep = np.broadcast_to(allowed, total.shape)
        listed = None
        for i, (a, b) in enumerate(self.steps):
            if listed is None:
                total += mine[a:b].T @ theirs[a:b]
                bound = np.outer(self.rests[i, part], length[i]).astype(mine.dtype)
                if b < len(mine) and np.isinf(floor).any() and total.shape[1] > self.k:
                    # No k-th best yet: the k-th largest of what pairs score at least.
                    least = np.where(keep, total - bound, -np.inf)
                    floor = np.maximum(floor, np.partition(least, -self.k, axis=1)[:, -self.k] - 2)
                # Scores are whole numbers; 2 is more than rounding can take away from a bound.
                keep = allowed & (total + bound >= floor[:, None].astype(mine.dtype) - 2)
                if np.count_nonzero(keep) < SPARSE * keep.size:
                    query, row = np.nonzero(keep)
                    listed = total[query, row]
            else:
                for d in range(a, b):
                    listed += mine[d][query] * theirs[d][row]
                left = listed + self.rests[i, part][query] * length[i][row] >= floor[query] - 2
                query, row, listed = query[left], row[left], listed[left]
        if listed is None:
            query, row = np.nonzero(keep)
            listed = total[query, row]
        left = listed >= floor[query]
        return query[left], row[left], listed[left]

    def rows(self, q: int) -> pa.RecordBatch:
        who, rank = np.nonzero(np.arange(self.k)[None, :] < self.filled[:, None])
        own = own_scores(self.queries)
        columns = [np.full(len(who), q), who, self.queries.ids[who], own[who], self.ids[who, rank], self.scores[who, rank]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], FOUND.replace(" BIGINT", "").split(", "))


def own_scores(block: Block) -> np.ndarray:
    """The inner product of each vector with itself."""
    numbers = block.numbers.astype(exact_type(block, block))
    if numbers.dtype == np.float32:
        numbers = numbers.astype(np.float64)
    return as_long((numbers * numbers).sum(axis=0))


def best_of(queries: DataFrame, candidates: DataFrame, k: int, same_label: bool = False) -> DataFrame:
    """For every query, its ``k`` best rows but itself: the columns of ``FOUND`` and ``rank`` from 1.

    ``queries`` and ``candidates`` are tables of blocks. A query is told from other rows of its id by leaving out one
    row of its id and its own score; such rows are alike in the result.
    """

    def meet(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        best = q = None
        for row in rows:
            if row["is_query"]:
                if best is not None:
                    yield best.rows(q)
                best, q = Best(opened(row), k + 1, same_label), row["q"]
            elif best is not None and q == row["q"]:
                best.meet(opened(row))
        if best is not None:
            yield best.rows(q)

    found = Grid(queries, candidates).over(meet, FOUND)
    order = W.partitionBy("q", "slot").orderBy(F.col("score").desc(), "vec_id")
    # Spark keeps k + 1 rows of a query in each task before it shuffles them.
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    own = ((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own_score"))).cast("int")
    owns = F.sum(own).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    others = first.withColumn("_own", own).withColumn("_owns", owns).where("not (_own = 1 and _owns = 1)")
    ranked = others.withColumn("rank", F.col("rank") - F.least("_owns", F.lit(1))).where(F.col("rank") <= k)
    return ranked.withColumn("vec_id", F.nullif("vec_id", F.lit(int(NO_ID)))).drop("_own", "_owns")


def nearest_rows(
    vectors: DataFrame, is_query, k: int, scale: float = 64, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product for every row that is a query.

    ``is_query`` is a condition on ``vectors``. Components become ``floor(scale * x)``; scores are whole numbers, and
    ties go to the smaller id, null ids last. Every row is a candidate but the query itself; another row of the same
    id is one, too, and each repeated query row has its own result. Rows whose vector is null or holds a null or a
    non-finite component take no part. Shorter vectors count as filled up with zeros; empty ones score 0. A score
    that does not fit in a long raises. Further columns are not read. An empty table gives no rows.
    """
    asked = query_blocks(vectors.where(is_query), key, vector, scale)
    found = best_of(asked, candidate_blocks(vectors, key, vector, scale), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
