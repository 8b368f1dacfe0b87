"""Mixing sources to target weights by weighted sampling without replacement.

Each document gets an exponential key, -ln(u) / quality, where u is a hash of its id, its text and, where rows
agree in both, of its number among them, so that rows of one id enter the mix one by one. Taking
documents in order of their keys until a token budget is reached is a weighted sample in the
sense of Efraimidis and Spirakis. A source whose target exceeds its size is taken whole as
often as it fits; only the rest is sampled.

The order is cut without sorting a source: keys fall into buckets by value, sums of buckets
tell in which bucket the budget ends, and only that bucket is sorted. A document is then taken
or not by comparing its own key with its source's cut, so no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tierline.llm.common import bitmap, broadcast_if_small, checkpointed, in_bitmap, stored

#: Weights of sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Size of the mix, as a share of all sizes, and the most often that a source is repeated.
SHARE = 1.5
MOST_EPOCHS = 2
#: Buckets of keys in each source; with n documents the sorted one holds about n / 4096.
BUCKETS = 4096
#: Characters that count against a document's quality.
SYMBOLS = "#$%&*|!~^<>{}[]=+_@"
NULL_ID = -(2**63)
#: The order in which a source's rows are taken.
ORDER = ("_key", "_id", "_digest", "_number")


def size_in_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality(text: Column) -> Column:
    """Share of characters that are no symbols, between 0 and 1; one is added to both counts."""
    whole = F.coalesce(text, F.lit(""))
    return (F.length(F.translate(whole, SYMBOLS, "")) + 1).cast("double") / (F.length(whole) + 1)


def uniform(id_column: Column, digest: Column, number: Column) -> Column:
    """A number between 0 and 1 (neither included) that depends on the id, the text's digest and the row's number."""
    whole = F.concat_ws(" ", F.coalesce(id_column.cast("string"), F.lit("null")), digest, number)
    return (F.conv(F.substring(F.md5(whole), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def _measured(df: DataFrame, text: str) -> DataFrame:
    """``df`` (doc, source and others) with what the mix needs to know of each row in place of its text."""
    out = df.withColumns(
        {
            "_source": F.col("source"),
            "_id": F.coalesce(F.col("doc").cast("long"), F.lit(NULL_ID)),
            "_size": size_in_words(F.col(text)),
            "_quality": quality(F.col(text)),
            "_digest": F.md5(F.coalesce(F.col(text), F.lit(""))),
        }
    )
    return out.withColumn("_same", F.xxhash64("_source", "_id", "_digest")).drop("source", text)


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` of ``_measured`` with ``_key`` and ``_bucket``, and ``_number`` among rows alike in source, id and text.

    Only rows that may be repeated are regrouped, by the task that read them: each task's rows of a group
    are numbered apart, from the sum of those before, so a group of any size is spread over tasks.
    """
    repeated = rows.groupBy("_same").count().where("count > 1").select("_same")
    marked = in_bitmap(rows, bitmap(repeated), "_same", "_again")
    again = marked.where("_again").withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    again = stored(again, "repeated-rows")
    before = F.sum("count").over(W.partitionBy("_same").orderBy("_part")) - F.col("count")
    starts = again.groupBy("_same", "_part").count().select("_same", "_part", before.alias("_start"))
    place = F.row_number().over(W.partitionBy("_same", "_part").orderBy("_place")) - 1
    numbered = again.join(starts, ["_same", "_part"]).withColumn("_number", F.col("_start") + place)
    once = marked.where(~F.col("_again")).withColumn("_number", F.lit(0).cast("long")).drop("_again")
    every = once.unionByName(numbered.select(once.columns))
    u = uniform(F.col("doc"), F.col("_digest"), F.col("_number"))
    every = every.withColumn("_key", -F.ln(u) / F.col("_quality"))
    # Keys are close to exponential, so their distribution function deals them out evenly.
    return every.withColumn("_bucket", F.least(F.floor(BUCKETS * (1 - F.exp(-F.col("_key")))), F.lit(BUCKETS - 1)).cast("int"))


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(_source, _total) with ``_target`` words: the share dealt out by weight, capped at ``most`` times _total.

    What caps cut off is dealt out again by weight. Sources ordered by cap over weight are capped up
    to some point; the level there follows from running sums. One row for each source.
    """
    place = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last()))
    weighed = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (place - 1) % len(weights) + 1))
    capped = weighed.withColumn("_cap", most * F.col("_total")).withColumn("_full", F.col("_cap") / F.col("_weight"))
    ahead = W.orderBy("_full", F.col("_source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(1))
    level = (share * F.sum("_total").over(whole) - F.coalesce(F.sum("_cap").over(ahead), F.lit(0))) / (
        F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(ahead), F.lit(0))
    )
    levelled = capped.withColumn("_level", level)
    # The level of the first source that is not capped holds for all after it.
    open_level = F.min(F.when(F.col("_level") < F.col("_full"), F.struct("_full", F.col("_source").isNull(), "_source", "_level"))).over(whole)
    held = levelled.withColumn("_open", open_level["_level"])
    return held.select(
        "_source",
        "_total",
        F.when(F.col("_open").isNull(), F.col("_cap").cast("double"))
        .otherwise(F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_open")))
        .alias("_target"),
    )


def plan(small: DataFrame) -> DataFrame:
    """For each source of ``small`` (_source, _size, _key, _bucket and ORDER): target, epochs and cut."""
    sums = small.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"))
    sums = checkpointed(sums)
    totals = sums.groupBy("_source").agg(F.sum("_sum").alias("_total"))
    aims = targets(totals)
    epochs = F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(0)
    aims = checkpointed(aims.withColumn("_epochs", epochs.cast("long")).withColumn("_rest", F.col("_target") - F.col("_epochs") * F.col("_total")))
    run = W.partitionBy("_source").orderBy("_bucket")
    before = sums.withColumn("_before", F.sum("_sum").over(run) - F.col("_sum"))
    joined = before.alias("b").join(aims.alias("a"), F.col("b._source").eqNullSafe(F.col("a._source"))).select("b.*", "a._rest")
    cut = joined.where("_before + _sum > _rest").groupBy("_source").agg(F.min(F.struct("_bucket", "_before", "_rest")).alias("c"))
    cut = cut.select("_source", "c.*")
    inside = small.alias("s").join(
        cut.alias("c"), F.col("s._source").eqNullSafe(F.col("c._source")) & (F.col("s._bucket") == F.col("c._bucket"))
    ).select("s.*", "c._before", "c._rest")
    order = W.partitionBy("_source").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0)
    middle = F.col("_before") + F.sum("_size").over(order) - F.col("_size") / 2
    last = inside.withColumn("_middle", middle).where("_middle <= _rest").groupBy("_source").agg(F.max(F.struct(*ORDER)).alias("_last"))
    ends = cut.alias("c").join(last.alias("l"), F.col("c._source").eqNullSafe(F.col("l._source")), "left")
    ends = ends.select(F.col("c._source"), F.col("c._bucket").alias("_cut"), "l._last")
    both = aims.alias("a").join(ends.alias("e"), F.col("a._source").eqNullSafe(F.col("e._source")), "left")
    return checkpointed(both.select("a.*", "e._cut", "e._last"))


def _times(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    joined = keyed.alias("k").join(broadcast_if_small(cuts).alias("p"), F.col("k._source").eqNullSafe(F.col("p._source")))
    joined = joined.select("k.*", "p._total", "p._target", "p._epochs", "p._cut", "p._last")
    here = F.struct(*ORDER)
    more = (
        F.col("_cut").isNull()
        | (F.col("_bucket") < F.col("_cut"))
        | ((F.col("_bucket") == F.col("_cut")) & F.coalesce(here <= F.col("_last"), F.lit(False)))
    )
    # A source whose target is met by whole epochs has no rest to sample.
    return joined.withColumn("_times", F.col("_epochs") + (more & (F.col("_target") > F.col("_epochs") * F.col("_total"))).cast("long"))


def mixed_words(df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each row of ``df``: id, size, source_size, target, taken.

    ``taken`` is the row's size times how often the mix takes it. A null text has size 0. Null
    is a source of its own, a null id an id. Rows that repeat, in their id or in everything, are taken one
    by one; of rows alike in source, id and text it does not matter which. A source without words has target
    0. An empty table gives no rows.
    """
    rows = df.select(F.col(id_column).alias("doc"), F.col(text).alias("text"), F.col(source).alias("source"))
    small = checkpointed(_keyed(stored(_measured(rows, "text"), "sizes")))
    return _times(small, plan(small)).select(
        F.col("doc").alias(id_column),
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_times") * F.col("_size")).alias("taken"),
    )


def mix(df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, with all columns of ``df``.

    Texts stay where they are, but for rows that repeat; only the cut of each source is joined to them.
    """
    held = df.select(F.struct("*").alias("_doc"), F.col(id_column).alias("doc"), F.col(text).alias("_text"), F.col(source).alias("source"))
    keyed = _keyed(_measured(held, "_text"))
    small = checkpointed(keyed.select("_source", "_size", "_bucket", *ORDER))
    taken = _times(keyed, plan(small)).where("_times > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_doc.*")
