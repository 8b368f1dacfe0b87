"""Hard negatives for anchors, by a secondary sort of pair scores.

The pairs of a row that can matter are packed into keys (anchor, kind-adjusted descending score, id), shuffled by
anchor and sorted inside the partitions, which is what ``repartitionAndSortWithinPartitions`` does, here on
DataFrames. An iterator reads each partition once: a positive opens its window of scores, and each negative that
follows goes to the open windows that hold its score. An anchor's pairs are never gathered.

Before the shuffle, tasks keep what can still be returned: the first positives of each anchor are found by the
exact top-k search, and then, of each task's negatives, the first few of every window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import arrow_map, shuffle_width, stored
from tierline.llm.topk import TILE, best_of
from tierline.llm.vector_blocks import NO_ID, Block, Grid, as_long, candidate_blocks, exact_type, opened, query_blocks

# Positives of an anchor, negatives of a positive, and the share of the positive's score, in
# hundredths, that a negative's score lies between.
POSITIVES = 5
NEGATIVES = 10
WINDOW = 30, 90

_KEY = np.dtype([("anchor", ">u8"), ("descending", ">u8"), ("negative", "u1"), ("id", ">u8")])
_SIGN = np.uint64(1 << 63)
_SENT = "anchor BIGINT, anchor_id BIGINT, key BINARY"
MINED = "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, positive_score BIGINT, negative_score BIGINT"


def _share(score: np.ndarray, hundredths: int) -> np.ndarray:
    """floor(score * hundredths / 100) without overflow."""
    return hundredths * (score // 100) + (hundredths * (score % 100)) // 100


def window_of(score: np.ndarray, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and the highest score of a negative for a positive of ``score``."""
    return -_share(-score, window[0]), _share(score, window[1])


def pack_keys(anchor: np.ndarray, score: np.ndarray, negative: bool, ids: np.ndarray) -> list[bytes]:
    """Keys whose bytes order by anchor, score from the highest, positives before negatives, id."""
    keys = np.empty(len(anchor), _KEY)
    keys["anchor"] = anchor.astype(np.uint64)
    keys["descending"] = ~(score.astype(np.int64).view(np.uint64) ^ _SIGN)
    keys["negative"] = negative
    keys["id"] = ids.astype(np.int64).view(np.uint64) ^ _SIGN
    return [k.tobytes() for k in keys]


def unpack_keys(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, score, negative, id) of packed keys."""
    k = np.frombuffer(b"".join(keys), _KEY)
    score = (~k["descending"].astype(np.uint64) ^ _SIGN).view(np.int64)
    return k["anchor"].astype(np.int64), score, k["negative"] == 1, (k["id"].astype(np.uint64) ^ _SIGN).view(np.int64)


class Windows:
    """Of each window of the anchors of a block, the first negatives of the candidates seen so far."""

    def __init__(self, anchors: Block, positives: list[dict], n: int, window: tuple[int, int]) -> None:
        self.anchors, self.n = anchors, n
        slots = np.array([p["slot"] for p in positives], np.int64)
        scores = np.array([p["score"] for p in positives], np.int64)
        order = np.argsort(slots, kind="stable")
        #: One entry for each positive: its anchor and the scores its negatives may have.
        self.slot = slots[order]
        self.low, self.high = window_of(scores[order], window)
        self.of = np.searchsorted(self.slot, np.arange(len(anchors.ids) + 1))
        self.scores = np.zeros((len(order), n), np.int64)
        self.ids = np.zeros((len(order), n), np.int64)
        self.places = np.zeros((len(order), n), np.int64)
        self.filled = np.zeros(len(order), np.int64)
        self.seen = 0

    def meet(self, candidates: Block) -> None:
        exact = exact_type(self.anchors, candidates)
        both = min(len(self.anchors.numbers), len(candidates.numbers))
        mine = self.anchors.numbers[:both].astype(exact)
        theirs = candidates.numbers[:both].astype(exact)
        for a in range(0, len(self.anchors.ids), TILE[0]):
            part = slice(a, min(a + TILE[0], len(self.anchors.ids)))
            windows = slice(self.of[part.start], self.of[part.stop])
            if windows.start == windows.stop:
                continue
            for c in range(0, len(candidates.ids), TILE[1]):
                of = slice(c, min(c + TILE[1], len(candidates.ids)))
                scores = np.asarray(mine[:, part].T @ theirs[:, of]).reshape(part.stop - a, -1)
                scores = as_long(scores) if exact is object else scores
                self._add(part, windows, scores, candidates, of)
        self.seen += len(candidates.ids)

    def _add(self, part: slice, windows: slice, scores: np.ndarray, candidates: Block, of: slice) -> None:
        full = self.filled[windows] == self.n
        least = np.where(full, np.maximum(self.low[windows], self.scores[windows, -1]), self.low[windows])
        other = self.anchors.labels[part, None] != candidates.labels[None, of]
        at = self.slot[windows] - part.start
        # The widest range of an anchor's windows first, then each window by itself.
        lowest = np.full(scores.shape[0], np.iinfo(np.int64).max)
        highest = np.full(scores.shape[0], np.iinfo(np.int64).min)
        np.minimum.at(lowest, at, least)
        np.maximum.at(highest, at, self.high[windows])
        anchor, row = np.nonzero(other & (scores >= lowest[:, None]) & (scores <= highest[:, None]))
        if not len(anchor):
            return
        found = as_long(scores[anchor, row])
        first = self.of[part.start : part.stop + 1] - self.of[part.start]
        per = (first[1:] - first[:-1])[anchor]
        pair = np.repeat(np.arange(len(anchor)), per)
        window = np.arange(len(pair)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(first[anchor], per)
        inside = (found[pair] >= least[window]) & (found[pair] <= self.high[windows][window])
        pair, window = pair[inside], window[inside]
        held = np.arange(self.n)[None, :] < self.filled[windows, None]
        place = self.seen + of.start + row[pair]
        who = np.concatenate([np.nonzero(held)[0], window])
        new = [
            np.concatenate([mine[windows][held], theirs])
            for mine, theirs in ((self.scores, found[pair]), (self.ids, candidates.ids[of][row[pair]]), (self.places, place))
        ]
        order = np.lexsort((new[1], ~new[0], who))
        who = who[order]
        rank = np.arange(len(who)) - np.searchsorted(who, np.arange(len(full)))[who]
        keep = rank < self.n
        for mine, theirs in zip((self.scores, self.ids, self.places), new):
            mine[who[keep] + windows.start, rank[keep]] = theirs[order][keep]
        self.filled[windows] = np.minimum(np.bincount(who, minlength=len(full)), self.n)

    def negatives(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all kept, each row once for its anchor."""
        window, rank = np.nonzero(np.arange(self.n)[None, :] < self.filled[:, None])
        slot, place = self.slot[window], self.places[window, rank]
        _, once = np.unique(np.stack([slot, place]), axis=1, return_index=True)
        return slot[once], self.scores[window, rank][once], self.ids[window, rank][once]


def _sent(q: int, anchors: Block, negative: bool, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    anchor = (q << 32) + slot
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()), pa.array(anchors.ids[slot], pa.int64()),
         pa.array(pack_keys(anchor, score, negative, ids), pa.binary())],
        ["anchor", "anchor_id", "key"],
    )


def mined(sorted_pairs: DataFrame, n: int, window: tuple[int, int]) -> DataFrame:
    """The negatives of every positive, from partitions sorted by key, read once."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_ = None, []
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            anchors, scores, negatives, ids = unpack_keys(batch.column("key").to_pylist())
            anchor_ids = batch.column("anchor_id").to_pylist()
            lows, highs = window_of(scores, window)
            for anchor, anchor_id, score, negative, id_, low, high in zip(
                anchors.tolist(), anchor_ids, scores.tolist(), negatives.tolist(), ids.tolist(), lows.tolist(), highs.tolist()
            ):
                if anchor != now:
                    now, open_ = anchor, []
                named = None if id_ == NO_ID else id_
                if not negative:
                    open_.append([named, score, low, high, 0])
                    continue
                for positive in open_:
                    if positive[4] < n and positive[2] <= score <= positive[3]:
                        positive[4] += 1
                        for column, v in zip(columns, (anchor_id, positive[0], positive[4], named, positive[1], score)):
                            column.append(v)
                # Scores only fall from here on.
                open_ = [p for p in open_ if p[4] < n and p[2] <= score]
            types = [pa.int32() if i == 2 else pa.int64() for i in range(6)]
            names = [part.split(" ")[0] for part in MINED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return arrow_map(sorted_pairs.select("anchor_id", "key"), stream, MINED)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    scale: float = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every row that is an anchor.

    Components become ``floor(scale * x)``, scores are inner products with the anchor, and equal scores go by the
    smaller id, null ids last. The first ``positives`` other rows of the anchor's label are its positives; for each,
    the first ``negatives`` rows of other labels whose score is from ``window[0]`` to ``window[1]`` hundredths of the
    positive's. A positive with a negative score has an empty window. Rows with a null label or vector, or a null or
    non-finite component, take no part; labels are whole numbers. Repeated rows are rows of their own, as anchors,
    positives and negatives. An anchor without positives, or without fitting negatives, gives no rows, as does an
    empty table. Shorter vectors count as filled up with zeros, further columns are not read, and a score that does
    not fit in a long raises.
    """
    labelled = vectors.where(vectors[f"`{label}`"].isNotNull())
    candidates = candidate_blocks(labelled, key, vector, scale, label)
    anchors = query_blocks(labelled.where(is_anchor), key, vector, scale, label)
    alike = stored(best_of(anchors, candidates, positives, same_label=True), "positives")
    # At most ``positives`` entries for each anchor of a block, whose size is fixed.
    chosen = alike.groupBy("q").agg(F.collect_list(F.struct("slot", "score", F.coalesce("vec_id", F.lit(int(NO_ID))).alias("id"))).alias("positives"))

    def meet(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        windows = q = None
        for row in rows:
            if row["is_query"]:
                if windows is not None:
                    yield _sent(q, windows.anchors, True, *windows.negatives())
                q, opened_anchors, found = row["q"], opened(row), row["positives"] or []
                windows = Windows(opened_anchors, found, negatives, window)
                if row["stripe"] == 0:
                    columns = (np.array([p[c] for p in found], np.int64) for c in ("slot", "score", "id"))
                    yield _sent(q, opened_anchors, False, *columns)
            elif windows is not None and q == row["q"]:
                windows.meet(opened(row))
        if windows is not None:
            yield _sent(q, windows.anchors, True, *windows.negatives())

    pairs = Grid(anchors.join(chosen, "q", "left"), candidates).over(meet, _SENT)
    dealt = pairs.repartition(shuffle_width(vectors.sparkSession), "anchor")
    return mined(dealt.sortWithinPartitions("key"), negatives, window)


def relabelled(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, label): where the id is divisible by 7, the label is the next of ten."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", shifted.alias("label"))
