"""Top-k retrieval over customer summaries and answers grounded in the hits."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierline.functions.text import customer_sentence, grounded_answer
from tierline.functions.vectors import squared_l2
from tierline.sources import snapshot_table

# Hits per question and the default question.
TOP_K = 3
DEFAULT_QUESTION = "Who is our most valuable customer?"

DIMENSIONS = 512
_TABLE = "documents"
_COUNTS = "counts"
_WORDS = "words"


class EmptyIndex(RuntimeError):
    """There is no customer to index."""


def customer_documents(ltv: DataFrame) -> DataFrame:
    """One document per customer: id, text and metadata."""
    return ltv.select(
        F.col("customer_id").cast("string").alias("id"),
        customer_sentence(
            F.col("customer_id"),
            F.col("orders"),
            F.col("lifetime_revenue"),
            F.col("first_seen"),
            F.col("last_seen"),
        ).alias("text"),
        F.struct("customer_id", "orders", "lifetime_revenue").alias("metadata"),
    )


def fit_embedder(documents: DataFrame, dimensions: int = DIMENSIONS) -> PipelineModel:
    """Text to unit vectors of hashed, rarity-weighted words; one pass to count words.

    A text whose words all occur in every document gives the zero vector.
    """
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"\W+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dimensions),
        IDF(inputCol="_tf", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(documents)


def embedded(texts: DataFrame, embedder: PipelineModel) -> DataFrame:
    """``texts`` with an ``embedding`` array; runs on the JVM."""
    vectors = embedder.transform(texts).withColumn(
        "embedding", vector_to_array("_unit", "float32")
    )
    return vectors.select(*texts.columns, "embedding")


def words_of(texts: DataFrame, *columns: str) -> DataFrame:
    """(columns, word, n): how often each word stands in each text; any letters and digits make words."""
    parts = F.filter(F.split(F.lower("text"), r"(?U)\W+"), lambda w: w != "")
    return texts.select(*columns, F.explode(parts).alias("word")).groupBy(*columns, "word").agg(F.count("*").alias("n"))


def _rarity(total: Column, documents: Column) -> Column:
    return F.log((total + 1) / (documents + 1))


def _sum(values: Column) -> Column:
    """Adds the smallest first, so that equal terms give equal sums in any order of rows."""
    return F.aggregate(F.array_sort(values), F.lit(0.0), lambda total, v: total + v)


def build_index(ltv: DataFrame, path: str) -> int:
    """Replace the index at ``path`` with the customers of ``ltv``; returns its version.

    Beside the documents it holds in how many of them each word occurs, and (word, id, weight) for each word
    of a document that is not in all of them. The squares of a document's weights add up to 1.
    """
    documents = customer_documents(ltv)
    if documents.isEmpty():
        raise EmptyIndex("customer_ltv has no rows, build the marts first")
    version = snapshot_table.overwrite(documents, f"{path}/{_TABLE}")
    documents = snapshot_table.read(ltv.sparkSession, f"{path}/{_TABLE}")
    found = words_of(documents, "id")
    snapshot_table.overwrite(found.groupBy("word").agg(F.count("*").alias("documents")), f"{path}/{_COUNTS}")
    counts = snapshot_table.read(ltv.sparkSession, f"{path}/{_COUNTS}")
    total = documents.agg(F.count("*").alias("total")).scalar()
    raw = found.join(counts, "word").select("id", "word", (F.col("n") * _rarity(total, F.col("documents"))).alias("raw")).where("raw > 0")
    norms = raw.groupBy("id").agg(F.sqrt(_sum(F.collect_list(F.col("raw") * F.col("raw")))).alias("norm"))
    snapshot_table.overwrite(raw.join(norms, "id").select("word", "id", (F.col("raw") / F.col("norm")).alias("weight")), f"{path}/{_WORDS}")
    return version


def nearest(documents: DataFrame, query: Column, k: int = TOP_K) -> DataFrame:
    """The ``k`` documents nearest to one query vector, exactly, with ``distance``.

    ``query`` is a literal array or a scalar subquery. Every task scans its documents
    and keeps ``k`` of them; only those are merged. Equal distances go by id.
    """
    columns = [c for c in documents.columns if c != "embedding"]
    return (
        documents.withColumn("_query", query)
        .select(*columns, squared_l2(F.col("embedding"), F.col("_query")).alias("distance"))
        .orderBy("distance", "id")
        .limit(k)
    )


def retrieve_all(spark: SparkSession, path: str, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """Hits for a table of questions (question_id, question): question_id, rank, id, text, metadata, distance.

    Distances are exact: 2 - 2 x cosine over all words, weighted by rarity. Only documents that share a word of some
    weight with the question are hits, so a question about nothing in the index has none. Equal distances go by id. The
    words of the questions are looked up in the index; a task keeps ``k`` documents of a question before the shuffle.
    """
    documents = snapshot_table.read(spark, f"{path}/{_TABLE}")
    counts = snapshot_table.read(spark, f"{path}/{_COUNTS}")
    weights = snapshot_table.read(spark, f"{path}/{_WORDS}")
    total = documents.agg(F.count("*").alias("total")).scalar()
    said = words_of(questions.select("question_id", F.col("question").alias("text")), "question_id")
    asked = said.join(counts, "word", "left")
    # A word of no document counts in the length of the question.
    asked = asked.select("question_id", "word", (F.col("n") * _rarity(total, F.coalesce("documents", F.lit(0)))).alias("asked")).where("asked > 0")
    lengths = asked.groupBy("question_id").agg(F.sqrt(_sum(F.collect_list(F.col("asked") * F.col("asked")))).alias("length"))
    dots = weights.join(asked, "word").groupBy("question_id", "id").agg(_sum(F.collect_list(F.col("weight") * F.col("asked"))).alias("dot"))
    scored = dots.join(lengths, "question_id").select("question_id", "id", (2.0 - 2.0 * F.col("dot") / F.col("length")).alias("distance"))
    best = W.partitionBy("question_id").orderBy("distance", "id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return documents.join(ranked, "id").select("question_id", "rank", *documents.columns, "distance")


def _one(spark: SparkSession, question: str) -> DataFrame:
    return spark.createDataFrame([(0, question)], "question_id INT, question STRING")


def retrieve(spark: SparkSession, path: str, question: str, k: int = TOP_K) -> DataFrame:
    """Hits for one question: id, text, metadata, distance, nearest first; see ``retrieve_all``."""
    hits = retrieve_all(spark, path, _one(spark, question), k)
    return hits.drop("question_id", "rank").orderBy("distance", "id").limit(k)


def compose_answer(question: str, hits: DataFrame) -> DataFrame:
    """One row with the answer text for the hits, of which there are at most k."""
    ranked = F.array_sort(F.collect_list(F.struct("distance", "id", "text", "metadata")))
    return hits.agg(ranked.alias("hits")).select(
        F.lit(question).alias("question"),
        grounded_answer(F.lit(question), F.col("hits")).alias("answer"),
    )


def ask_all(spark: SparkSession, path: str, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """(question_id, question, answer) for every question; one that nothing matches is told so."""
    hits = retrieve_all(spark, path, questions, k)
    ranked = F.array_sort(F.collect_list(F.struct("distance", "id", "text", "metadata")))
    per_question = hits.groupBy("question_id").agg(ranked.alias("hits"))
    found = F.coalesce("hits", F.array().cast(per_question.schema["hits"].dataType))
    return questions.join(per_question, "question_id", "left").select(
        "question_id", "question", grounded_answer(F.col("question"), found).alias("answer")
    )


def ask(spark: SparkSession, path: str, question: str = DEFAULT_QUESTION, k: int = TOP_K) -> DataFrame:
    return ask_all(spark, path, _one(spark, question), k).drop("question_id")
