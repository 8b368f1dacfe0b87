"""Nearest vectors for a whole table of questions: exactly, or through lists around trained centres.

Questions are taken in blocks of a fixed number of rows. A block is known to every task; each task multiplies it with
its batches of documents, keeps the best few of every question, and only those are shuffled. The product gives
distances up to rounding; whatever could be among the best is added up again component by component, so distances are
the same as those of ``retrieval.nearest``, whatever the batches were.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources import snapshot_table

#: Questions of a block; with their vectors this is what a job broadcasts.
BLOCK = 1024
#: Documents the centres are trained on, at most; all documents are indexed.
SAMPLE = 20_000
CENTRES, PROBES = 32, 8
LIST = "_list"


def _ship(spark: SparkSession) -> None:
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def _matrix(column: pa.ListArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of ``dims`` numbers as rows of doubles, and where they stand; others have no distance."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(lengths == dims)
    flat = column.take(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(fits), dims)
    known = np.isfinite(rows).all(axis=1)
    return rows[known], fits[known]


def _added_up(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows, added from the first component to the last."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total = total + (a[:, j] - b[:, j]) ** 2
    return total


class _Best:
    """The ``k`` nearest documents of every question of a block."""

    def __init__(self, questions: np.ndarray, k: int) -> None:
        self.questions, self.k = questions, k
        self.squares = np.square(questions).sum(axis=1)
        self.limit = np.full(len(questions), np.inf)
        self.who: np.ndarray = np.empty(0, np.int64)
        self.distance: np.ndarray = np.empty(0)
        self.ids: list = []

    def meet(self, documents: np.ndarray, ids: list, of: np.ndarray | None = None) -> None:
        """Documents for all questions, or those in ``of``."""
        of = np.arange(len(self.questions)) if of is None else of
        if not len(documents) or not len(of):
            return
        squares = np.square(documents).sum(axis=1)
        rough = self.squares[of, None] + squares[None, :] - 2 * (self.questions[of] @ documents.T)
        # More than the product can be off by, so no document that belongs to the best is left out.
        slack = 1e-9 * (self.squares[of].max() + squares.max()) + 1e-300
        limit = self.limit[of]
        if len(documents) > self.k:
            limit = np.minimum(limit, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1] + slack)
        near, row = np.nonzero(rough <= limit[:, None] + slack)
        distance = _added_up(self.questions[of[near]], documents[row])
        self.who = np.concatenate([self.who, of[near]])
        self.distance = np.concatenate([self.distance, distance])
        self.ids += [ids[i] for i in row.tolist()]
        if len(self.ids) > 8 * self.k * len(self.questions):
            self._shrink()

    def _shrink(self) -> None:
        keep, taken = [], np.zeros(len(self.questions), np.int64)
        order = sorted(range(len(self.ids)), key=lambda i: (self.who[i], self.distance[i], self.ids[i] is None, self.ids[i]))
        for i in order:
            if taken[self.who[i]] < self.k:
                taken[self.who[i]] += 1
                keep.append(i)
                if taken[self.who[i]] == self.k:
                    self.limit[self.who[i]] = self.distance[i]
        self.who, self.distance, self.ids = self.who[keep], self.distance[keep], [self.ids[i] for i in keep]

    def rows(self, names: list, id_type: pa.DataType) -> pa.RecordBatch:
        self._shrink()
        return pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in self.who.tolist()], pa.int64()), pa.array(self.ids, id_type), pa.array(self.distance, pa.float64())],
            ["_question", "id", "distance"],
        )


def _blocks(questions: DataFrame) -> Iterator[list]:
    """The questions in blocks of BLOCK rows, one after the other at the driver; null and broken vectors are left out."""
    block: list = []
    for row in questions.select("question_id", "embedding").toLocalIterator():
        vector = row["embedding"]
        if vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        block.append((row["question_id"], vector))
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block


def _nearest(documents: DataFrame, block: list, k: int, lists: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(_question, id, distance): the best of each task for the questions of a block, by their place in it.

    With ``lists`` a question meets only documents whose list it probes.
    """
    _ship(documents.sparkSession)
    # Questions of different lengths never meet the same documents.
    by_length: dict[int, list[int]] = {}
    for i, (_, vector) in enumerate(block):
        by_length.setdefault(len(vector), []).append(i)
    spark = documents.sparkSession
    groups = [(np.array(at), np.array([block[i][1] for i in at], float).reshape(len(at), dims)) for dims, at in by_length.items()]
    shared = spark.sparkContext.broadcast((groups, lists))
    id_field = documents.schema["id"]
    schema = T.StructType([T.StructField("_question", T.LongType()), T.StructField("id", id_field.dataType), T.StructField("distance", T.DoubleType())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, lists = shared.value
        best = [(at, _Best(rows, k)) for at, rows in groups]
        id_type = None
        for batch in batches:
            id_type = batch.column("id").type
            for at, found in best:
                vectors, places = _matrix(batch.column("embedding"), found.questions.shape[1])
                ids = batch.column("id").take(pa.array(places)).to_pylist()
                if lists is None:
                    found.meet(vectors, ids)
                    continue
                lists_of = batch.column(LIST).take(pa.array(places)).to_numpy(zero_copy_only=False)
                for number in np.unique(lists_of):
                    asked = np.flatnonzero(np.isin(at, lists.get(int(number), ())))
                    here = np.flatnonzero(lists_of == number)
                    found.meet(vectors[here], [ids[i] for i in here.tolist()], asked)
        if id_type is not None:
            for at, found in best:
                yield found.rows(at.tolist(), id_type)

    columns = ["id", "embedding", *([LIST] if lists is not None else [])]
    return documents.select(*columns).mapInArrow(partial, schema)


def _ranked(found: DataFrame, block: list, question_type: T.DataType, k: int) -> DataFrame:
    spark = found.sparkSession
    names = T.StructType([T.StructField("_question", T.LongType()), T.StructField("question_id", question_type)])
    asked = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(block)], names)
    order = W.partitionBy("_question").orderBy("distance", F.col("id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(F.broadcast(asked), "_question").select("question_id", "rank", "id", "distance")


def _union(parts: list[DataFrame], questions: DataFrame, documents: DataFrame) -> DataFrame:
    if parts:
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    kinds = [questions.schema["question_id"].dataType, T.IntegerType(), documents.schema["id"].dataType, T.DoubleType()]
    names = ["question_id", "rank", "id", "distance"]
    return questions.sparkSession.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in zip(names, kinds)]))


def nearest_batch(documents: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """(question_id, rank, id, distance): the ``k`` documents nearest to each question, exactly.

    ``documents`` has ``id`` and ``embedding``, ``questions`` has ``question_id`` and ``embedding``. Equal distances go
    by id, null ids last. A document whose vector is null, holds nulls or non-finite numbers, or is of another length
    than the question's has no distance and is not found; a question of that kind finds nothing. Repeated questions
    are answered each. Every block of questions is one pass over the documents.
    """
    parts = [_ranked(_nearest(documents, b, k), b, questions.schema["question_id"].dataType, k) for b in _blocks(questions)]
    return _union(parts, questions, documents)


class Index(NamedTuple):
    """Documents divided into lists, a folder for each, and the centres of the lists."""

    documents: str
    centres: str


def index_at(path: str) -> Index:
    return Index(f"{path}/lists", f"{path}/centres")


def build_index(documents: DataFrame, path: str, centres: int = CENTRES, sample: int = SAMPLE, seed: int = 7) -> int:
    """Train centres on at most ``sample`` documents and file every document under the nearest; returns the version.

    The sample is the documents that come first by a hash of their id, so it repeats. Vectors must be of one length;
    documents with a null or broken vector are in no list. With fewer documents than centres, each has its own.
    """
    whole = documents.where(F.col("embedding").isNotNull()).where(
        F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    )
    drawn = whole.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample)
    vectors = drawn.select(array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    if vectors.isEmpty():
        raise ValueError("there is no vector to index")
    model = KMeans(k=centres, seed=seed, maxIter=12, initMode="k-means||").fit(vectors)
    points = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    spark, index = documents.sparkSession, index_at(path)
    snapshot_table.overwrite(spark.createDataFrame(points, f"{LIST} INT, centre ARRAY<DOUBLE>"), index.centres)
    features = array_to_vector(F.transform("embedding", lambda x: x.cast("double")))
    filed = model.setFeaturesCol("_features").setPredictionCol(LIST).transform(whole.withColumn("_features", features))
    return snapshot_table.overwrite(filed.drop("_features"), index.documents, (LIST,))


def search(spark: SparkSession, path: str, questions: DataFrame, k: int, probes: int = PROBES) -> DataFrame:
    """As ``nearest_batch``, over the ``probes`` lists whose centres are nearest to the question.

    Distances are exact; a document in a list that is not probed is missed. With as many probes as lists nothing is. Only
    folders of probed lists are read.
    """
    index = index_at(path)
    snap = snapshot_table.snapshot(spark, index.documents)
    rows = sorted(snapshot_table.read(spark, index.centres).collect())  # a fixed number of centres
    numbers, centres = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    documents, parts = snapshot_table.read_folders(spark, index.documents, snap), []
    for block in _blocks(questions):
        lists: dict[int, list[int]] = {}
        for i, (_, vector) in enumerate(block):
            if len(vector) == centres.shape[1]:
                away = np.square(centres - np.array(vector, float)).sum(axis=1)
                for n in numbers[np.argsort(away, kind="stable")[:probes]].tolist():
                    lists.setdefault(n, []).append(i)
        folders = [f for f in snap.folders if int(f.split("=")[1]) in lists]
        here = snapshot_table.read_folders(spark, index.documents, snap, folders)
        found = _nearest(here, block, k, {n: np.array(at) for n, at in lists.items()})
        parts.append(_ranked(found, block, questions.schema["question_id"].dataType, k))
    return _union(parts, questions, documents)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the exact neighbours, how many of them were found, and their share."""
    keys = ["question_id", "id"]
    hits = exact.join(found.select(*keys).distinct().withColumn("_hit", F.lit(1)), keys, "left")
    return hits.agg(F.count(F.lit(1)).alias("neighbours"), F.count("_hit").alias("found")).withColumn(
        "recall", F.when(F.col("neighbours") > 0, F.col("found") / F.col("neighbours"))
    )
