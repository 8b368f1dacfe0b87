"""From documents to token ids: the stages of a training corpus, each an operator of ``tierline.llm``.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. Its result is written
as Parquet and read again before the next stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm import exact_dedup, mixing, near_dedup, pieces, quality
from tierline.llm.common import stored


#: Texts that go to a Python worker together while they are encoded, as executors are fullest then. Results do not depend on it.
ENCODED_AT_ONCE = {"maxRecordsPerBatch": 2000, "maxBytesPerBatch": 8 << 20}
#: Words that a worker knows while it encodes, half of the operator's own number for the same reason.
ENCODED_KEPT = 300_000


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.keep_good(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts: the longest original, then the smallest id."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near-duplicates."""
    return near_dedup.drop_near(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encoded_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    for name, most in ENCODED_AT_ONCE.items():
        spark.conf.set(f"spark.sql.execution.arrow.{name}", most)
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), kept=ENCODED_KEPT)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("source_mix", mixed_sources),
    ("sentencepiece", encoded_texts),
]

#: The classifier, the near-duplicates and the encoding cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
