"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a full hash.

A first pass reads texts and keeps two numbers of each row, its length and a hash of its beginning.
Lengths are counted first; only rows whose length occurs again are grouped by their beginning too. Pairs
of both that occur again go into a filter; a second pass hashes the full content of the rows it lets
through only. A bit set by two different groups only costs a needless hash: the full hash decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Filter, bitmap, checkpointed, in_bitmap, stored

#: White space that does not count.
BLANK = " \t\n\x0b\x0c\r"
PREFIX_CHARS = 256

def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANK, "")


def _with_prefix(df: DataFrame, text: str) -> DataFrame:
    plain = df.withColumn("_plain", normalised(F.col(text)))
    head = F.xxhash64(F.substring("_plain", 1, PREFIX_CHARS))
    return plain.withColumns({"_len": F.length("_plain"), "_head": head})


def survivors(df: DataFrame, text: str = "text") -> Filter:
    """Filter over the (length, prefix hash) pairs that occur at least twice, among rows whose length does."""
    small = stored(_with_prefix(df, text).select("_len", "_head"), "lengths")
    lengths = small.groupBy("_len").count().where("count > 1")
    again = in_bitmap(small.withColumn("_long", F.col("_len").cast("long")), bitmap(lengths.select(F.col("_len").cast("long"))), "_long", "_again")
    pairs = again.where("_again").groupBy("_len", "_head").count().where("count > 1")
    return bitmap(pairs.select(F.xxhash64("_len", "_head")))


def _marked(df: DataFrame, bits: Filter, text: str) -> DataFrame:
    """Rows with ``_alive``: whether another row may share length and prefix."""
    at = _with_prefix(df, text).withColumn("_pair", F.xxhash64("_len", "_head"))
    return in_bitmap(at, bits, "_pair", "_alive").drop("_pair")


def _full_hash() -> Column:
    return F.sha2(F.col("_plain"), 256)


def exact_groups(df: DataFrame, id_column: str = "doc_id", text: str = "text", digest_all: bool = False) -> DataFrame:
    """One row for each row of ``df``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without white space. The row with the most code points
    stays, then the one with the smallest id (a null id counts as the largest). Of repeated
    rows that agree in text and id, each says the same keep_id and exactly one is kept.
    A null text is an empty one. An empty table gives no rows. Columns other than id and text
    are not read. ``text_sha256`` is null for texts that no full hash was needed for, unless
    ``digest_all``.
    """
    rows = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    marked = _marked(rows, survivors(rows, "_text"), "_text")
    digest = _full_hash() if digest_all else F.when(F.col("_alive"), _full_hash())
    small = checkpointed(
        marked.select(
            "_id",
            F.length(F.coalesce("_text", F.lit(""))).alias("_chars"),
            "_alive",
            digest.alias("text_sha256"),
            F.monotonically_increasing_id().alias("_place"),
        )
    )
    order = F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_place").alias("p"))
    groups = (
        small.where("_alive")
        .groupBy("text_sha256")
        .agg(F.min(order).alias("_best"), F.count("*").alias("_size"))
        .where("_size > 1")
    )
    found = small.where("_alive").join(groups, "text_sha256", "left")
    alone = small.where("not _alive").withColumns(
        {"_best": F.lit(None).cast(groups.schema["_best"].dataType), "_size": F.lit(None).cast("long")}
    )
    single = F.col("_size").isNull()
    return found.unionByName(alone).select(
        F.col("_id").alias(id_column),
        F.when(single, F.col("_id")).otherwise(F.col("_best.i")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("_best.p") == F.col("_place"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group of equal texts, chosen as in ``exact_groups``; all columns stay.

    Rows that the filter clears pass without a shuffle. Of the others, the best row of each full hash is
    found on hashes and ranks alone; only the rows that a second filter, of those, lets through have their
    texts shuffled, after copies alike in every column have been reduced in each task.
    """
    held = df.select(F.struct("*").alias("_doc"), F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    marked = _marked(held, survivors(df.select(F.col(text).alias("_text")), "_text"), "_text")
    free = marked.where(~F.col("_alive")).select("_doc.*")
    chars = F.length(F.coalesce("_text", F.lit("")))
    order = F.struct(
        (-chars).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.xxhash64("_doc").alias("d")
    )
    bound = marked.where("_alive").select("_doc", _full_hash().alias("_sha"), order.alias("_order"))
    best = stored(bound.groupBy("_sha").agg(F.min("_order").alias("_best")), "best-copies")
    winners = bitmap(best.select(F.xxhash64("_sha", "_best")))
    likely = in_bitmap(bound.withColumn("_rank", F.xxhash64("_sha", "_order")), winners, "_rank", "_hit").where("_hit")
    # Rows alike in every column are left; any one of them is the same row.
    once = likely.groupBy("_sha", "_order").agg(F.any_value("_doc").alias("_doc"))
    first = once.join(best, "_sha").where("_order <=> _best")
    return free.union(first.select("_doc.*"))
