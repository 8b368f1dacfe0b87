"""Near-duplicates by DartMinHash.

A text is a weighted set: its runs of five words, each weighing as often as it occurs. For every
element there is a plane of weight by rank over which darts are scattered at random, one to a
unit of area; hashes of the element fix their places, so all texts share them. A text throws the
darts that lie under its weights, from low ranks up, until each of K coordinates (to which
darts are dealt by hash) has one, and keeps the earliest for each coordinate. Two texts agree in a
coordinate with the probability of their weighted Jaccard similarity. Only about K log K darts are
thrown, however long the text.

Signatures are cut in bands and texts that share a band are candidates. A band's group is never
expanded into pairs. Its members are compared with a leader, what this leaves in separate classes
with more leaders, and so on, until each group is one class or all its pairs across classes have been
compared. So no link that would join two classes is lost. Every link is checked on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierline.llm.common import (
    arrow_map, bitmap, broadcast_if_small, checkpointed, components, in_bitmap, mixed, shingles, slices, stored, texts_of, word_hashes,
)

SIMILARITY = 0.8
#: Coordinates, and how many of them go into each band. At a similarity of 0.8 two texts share one of
#: the 24 bands with a probability of 0.99993.
COORDINATES, ROWS, BANDS = 512, 5, 24
#: Two bits of each coordinate are kept, in two planes. Both agree with similarity + (1 - similarity) / 4:
#: candidates 3.5 deviations below what 0.8 gives (a chance of 2 in 10000 at 0.8, of none to speak of above) are
#: not compared.
WORDS = COORDINATES // 64
LEAST_AGREE = 407
#: Ranks at which cells of the plane begin: [0, 1/256), then four times as far up to 1, then units.
_LOW = np.array([0, 2.0**-8, 2.0**-6, 2.0**-4, 2.0**-2])
_HIGH = np.array([2.0**-8, 2.0**-6, 2.0**-4, 2.0**-2, 1])
#: Cells that are in memory at once. Only speed and memory depend on it.
CELLS = 1 << 16
_BITS = [f"bits{i}" for i in range(2 * WORDS)]
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Elements of each text, and their number: a shingle's n-th occurrence is an element of its own.

    So the weighted Jaccard similarity of two texts is the plain one of their elements.
    """
    flat, per_text = shingles(*word_hashes(texts))
    owner = np.repeat(np.arange(len(texts)), per_text)
    order = np.lexsort((flat, owner))
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    place = np.arange(len(flat))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    return mixed(flat + nth.astype(np.uint64) * _GOLD), per_text


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def earliest_darts(flat: np.ndarray, per_text: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The lowest rank of a dart in each of k coordinates, a row for each text; infinite without elements."""
    out = np.full((len(per_text), k), np.inf)
    open_ = np.flatnonzero(per_text > 0)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    reach = np.where(per_text > 0, k * (np.log(k) + 4) / np.maximum(per_text, 1), 0)
    while len(open_):
        # Cells that each text's darts come from: those below its reach.
        cells = np.where(reach <= 1, np.searchsorted(_LOW, np.minimum(reach, 1), side="left"), 4 + np.ceil(reach)).astype(np.int64)
        take = np.isin(owner, open_) if len(open_) < len(per_text) else slice(None)
        e, own = flat[take], owner[take]
        ends = np.cumsum(cells[own])
        cuts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]) + CELLS, CELLS), side="right"))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            _throw(out, e[a:b], own[a:b], cells[own[a:b]])
        open_ = open_[np.isinf(out[open_]).any(axis=1)]
        reach[open_] *= 2
    return out


def _throw(out: np.ndarray, e: np.ndarray, own: np.ndarray, width: np.ndarray) -> None:
    """Lower ``out`` by the darts in the first ``width`` cells of each element."""
    k = out.shape[1]
    cell = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
    each = np.arange(int(width.max()))
    low = np.where(each < 5, _LOW[np.minimum(each, 4)], each - 4.0)
    size = np.where(each < 5, _HIGH[np.minimum(each, 4)], each - 3.0) - low
    seed = mixed(np.repeat(e, width) + ((each.astype(np.uint64) + np.uint64(1)) * _GOLD)[cell])
    none = np.exp(-size)[cell]
    live = np.flatnonzero(_unit(mixed(seed)) >= none)
    seed, cell, chance = seed[live], cell[live], none[live]
    u, below, own, low, size = _unit(mixed(seed)), chance.copy(), np.repeat(own, width)[live] * k, low[cell], size[cell]
    nth = 0
    while len(seed):
        nth += 1
        x = mixed(seed + np.uint64(nth * 0xD1B54A32D192ED03 % 2**64))
        np.minimum.at(out.reshape(-1), own + (x % np.uint64(k)).astype(np.int64), low + _unit(mixed(x)) * size)
        chance *= size / nth
        below += chance
        more = (u >= below) & (chance > 1e-18)
        seed, u, below, chance, own, low, size = (v[more] for v in (seed, u, below, chance, own, low, size))


def signatures(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys, and two planes of bits, one of each coordinate, in numbers of 64."""
    bits = mixed(ranks.view(np.uint64).reshape(ranks.shape))
    keys = np.zeros((len(ranks), BANDS), np.uint64)
    for j in range(ROWS):
        keys = mixed(keys * _GOLD + bits[:, j * BANDS : (j + 1) * BANDS])
    planes = [np.packbits((bits >> np.uint64(j) & np.uint64(1)).astype(bool), axis=1) for j in range(2)]
    low = np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)
    return keys.view(np.int64), low.reshape(len(ranks), 2 * WORDS)


def _node(flat: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """16 bytes that stand for a set of elements: two sums of mixed elements."""
    ends = np.concatenate(([0], np.cumsum(per_text)))
    out = np.zeros((len(per_text), 2), np.uint64)
    for j, salt in enumerate((0, 0x5851F42D4C957F2D)):
        run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(flat ^ np.uint64(salt)))))
        out[:, j] = run[ends[1:]] - run[ends[:-1]]
    return out


def _nodes(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x], pa.binary())


def sketched(rows: DataFrame) -> DataFrame:
    """From (id, mark, text): id, mark, node (same for same sets), n elements, bands, bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            for s in slices(texts):
                flat, per_text = elements(texts[s])
                keys, est = signatures(earliest_darts(flat, per_text))
                part = batch.slice(s.start, s.stop - s.start)
                ends = pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32())
                yield pa.record_batch(
                    [
                        part.column("id"), part.column("mark"), _nodes(_node(flat, per_text)), pa.array(per_text),
                        pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1))), *map(pa.array, est.T.copy()),
                    ],
                    names=["id", "mark", "node", "n", "bands", *_BITS],
                )

    return arrow_map(rows, run, "id long, mark long, node binary, n long, bands array<long>, " + ", ".join(f"{b} long" for b in _BITS))


def whole_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, elements) of the rows whose mark is among ``wanted``; texts of other rows are not read by Python."""
    few = in_bitmap(rows, bitmap(wanted), "mark", "hit").where("hit").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            for s in slices(texts):
                flat, per_text = elements(texts[s])
                ends = np.concatenate(([0], np.cumsum(per_text)))
                sets = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.record_batch([_nodes(_node(flat, per_text)), pa.array(sets, pa.binary())], names=["node", "elements"])

    return arrow_map(few, run, "node binary, elements binary").dropDuplicates(["node"])


def alike(pairs: DataFrame, sets: DataFrame, at_least: float) -> DataFrame:
    """Pairs (a, b) whose weighted Jaccard similarity is at least so high."""
    nodes = broadcast_if_small(pairs.select("a").union(pairs.select("b")).distinct().toDF("node"))
    needed = sets.join(nodes, "node", "left_semi")
    both = pairs.join(needed.toDF("b", "set_b"), "b").join(needed.toDF("a", "set_a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column("set_a"), b.column("set_b"), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                shared = len(x) + len(y) - len(np.union1d(x, y))
                good.append(shared >= at_least * (len(x) + len(y) - shared))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return arrow_map(both.select("a", "b", "set_a", "set_b"), run, "a binary, b binary")


def linked(rows: DataFrame, texts: DataFrame, at_least: float) -> DataFrame:
    """(id, root) of the nodes of ``texts`` in classes of more than one node."""
    bands = texts.where("n > 0").select("node", "n", *_BITS, F.posexplode("bands").alias("band", "key"))
    # A partial count first: one row for each task and group is shuffled.
    shared = bands.select("band", "key").groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(bands.join(shared, ["band", "key"]), "near-members")
    in_groups = members.select("node").distinct()
    sets = stored(whole_sets(rows, texts.join(in_groups, "node", "left_semi").select("mark")), "near-sets")
    tested = roots = None
    leaders, before = 1, 0
    while True:
        now = members.withColumn("root", F.col("node"))
        if roots is not None:
            now = members.join(roots.toDF("node", "r"), "node", "left").withColumn("root", F.coalesce("r", "node")).drop("r")
        mixed_groups = now.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
        now = stored(now.join(mixed_groups.select("band", "key"), ["band", "key"], "left_semi"), "near-open")
        largest = now.agg(F.max("size")).first()[0]
        if largest is None:
            break
        rank = F.row_number().over(W.partitionBy("band", "key").orderBy(F.xxhash64("node"), "node"))
        first = now.withColumn("rank", rank).where(F.col("rank") <= leaders).where(F.col("rank") > before)
        first = first.select("band", "key", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), *[F.col(b).alias(f"a_{b}") for b in _BITS])
        # Sizes and bits are compared inside the join, so only likely pairs come out of it.
        unlike = [F.col(b).bitwiseXOR(F.col(f"a_{b}")) for b in _BITS]
        differ = sum((F.bit_count(x.bitwiseOR(y)) for x, y in zip(unlike[:WORDS], unlike[WORDS:], strict=True)), F.lit(0))
        likely = (F.least("n", "na") >= at_least * F.greatest("n", "na")) & (differ <= COORDINATES - LEAST_AGREE)
        met = (F.col("l.band") == F.col("m.band")) & (F.col("l.key") == F.col("m.key")) & (F.col("l.ra") != F.col("m.root")) & likely
        found = first.alias("l").join(now.alias("m"), met).select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        pairs = found.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "near-pairs")
        tested = pairs if tested is None else tested.union(pairs)
        # The classes so far stand for the links that made them.
        new = alike(pairs, sets, at_least)
        roots = components(new if roots is None else roots.toDF("a", "b").union(new))
        if leaders >= largest:
            break
        # Leaders up to ``before`` have met every member of another class; their ranks stay the same.
        before, leaders = leaders, leaders * 8
    return roots if roots is not None else texts.select(F.col("node").alias("id"), F.col("node").alias("root")).limit(0)


def near_groups(df: DataFrame, id_column: str = "doc_id", text: str = "text", at_least: float = SIMILARITY) -> DataFrame:
    """One row for each row of ``df``: id, class_id, class_size, n_texts, kept, mark.

    A class holds texts that links of similarity ``at_least`` connect; equal sets of shingles are one text.
    ``class_id`` is the smallest id in the class (null if all are), ``n_texts`` its number of different
    texts. One row of a class is kept: that of the smallest id, of repeated rows the first one met. A null
    text is empty; texts without words are one class. A text of fewer than five words is one shingle. An
    empty table gives no rows. ``mark`` is a hash of id and text.
    """
    rows = _rows(df, id_column, text)
    sketch = stored(sketched(rows), "near-sketch").withColumn("place", F.monotonically_increasing_id())
    order = F.struct(F.col("id").isNull().alias("null"), F.col("id").alias("id"), "mark", "place")
    texts = stored(
        sketch.groupBy("node").agg(F.min(order).alias("first"), F.count("*").alias("copies"), F.any_value("n").alias("n"),
                                   F.any_value("bands").alias("bands"), *[F.any_value(b).alias(b) for b in _BITS])
        .select("node", "first", "first.mark", "copies", "n", "bands", *_BITS),
        "near-texts",
    )
    roots = linked(rows, texts, at_least)
    named = texts.select("node", "first", "copies").join(roots.toDF("node", "root"), "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    classes = named.groupBy("root").agg(F.min("first").alias("best"), F.sum("copies").alias("class_size"), F.count("*").alias("n_texts"))
    of_node = named.select("node", "root").join(classes, "root").select("node", "best", "class_size", "n_texts")
    return sketch.select("id", "mark", "place", "node").join(of_node, "node").select(
        F.col("id").alias(id_column),
        F.col("best.id").alias("class_id"),
        "class_size",
        "n_texts",
        ((F.col("best.place") == F.col("place")) & (F.col("best.mark") == F.col("mark"))).alias("kept"),
        "mark",
    )


def _rows(df: DataFrame, id_column: str, text: str) -> DataFrame:
    return df.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(F.col(id_column), F.col(text)).alias("mark"), F.col(text).alias("text"))


def drop_near(df: DataFrame, id_column: str = "doc_id", text: str = "text", at_least: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that ``near_groups`` keeps, with all their columns.

    Rows in no larger class pass without a shuffle; a fixed-size filter on their marks tells most of them.
    """
    groups = checkpointed(near_groups(df, id_column, text, at_least).select("mark", "class_size", "kept"))
    crowd = groups.where("class_size > 1")
    held = df.select(F.struct("*").alias("_doc"), F.xxhash64(F.col(id_column), F.col(text)).alias("mark"))
    told = in_bitmap(held, bitmap(crowd.select("mark")), "mark", "hit")
    stay = groups.where("kept").select("mark").distinct()
    bound = told.where("hit").join(stay, "mark", "left_semi")
    # Rows of one mark are copies of one another; one of them stays.
    once = bound.dropDuplicates(["mark"])
    return told.where("not hit").select("_doc.*").union(once.select("_doc.*"))
