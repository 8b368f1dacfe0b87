"""Quality from weak labels.

Several heuristic labellers each vote good, bad or nothing on every document. Expectation-
maximisation over the counts of vote patterns, of all documents, estimates how reliable each
labeller is, and so how likely a document with given votes is good. These posteriors label a bounded
sample, on which a linear scorer over hashed features is trained; the scorer judges every document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import arrow_map, kept_by, slices, texts_of

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Hashed features, and the most documents the scorer is trained on (chosen by a hash of their text).
FEATURES = 1 << 12
SAMPLE = 4000
CUT = 0.5
LABELLERS = ("runs of marks", "odd marks", "capitals", "flow", "pairs", "runs of words", "variety")
ODD = "#$%&*|~^<>{}=!"
_KEPT_TOKENS = 300_000


def votes(text: str, tokens: list[str]) -> tuple[int, ...]:
    """A vote of each labeller: 1 good, -1 bad, 0 none. An empty text gets a bad one from all."""
    if not tokens:
        return (-1,) * len(LABELLERS)
    word = [t[0].isalnum() for t in tokens]
    plain = [t for t, w in zip(tokens, word, strict=True) if w]
    n = max(len(plain), 1)
    runs_of_marks = sum(len(t) > 1 and not w for t, w in zip(tokens, word, strict=True)) / n
    odd = sum(map(text.count, ODD)) / n
    upper = sum(t.isupper() and len(t) > 1 for t in plain) / n
    together = sum(a and b for a, b in zip(word, word[1:], strict=False)) / n
    pairs = len(set(zip(plain, plain[1:], strict=False))) / max(n - 1, 1)
    same = sum(a == b for a, b in zip(plain, plain[1:], strict=False)) / n
    distinct = len(set(plain)) / n
    return (
        -1 if runs_of_marks > 0.2 else 1 if runs_of_marks < 0.05 else 0,
        -1 if odd > 0.2 else 1 if odd < 0.05 else 0,
        -1 if upper > 0.4 else 1 if upper < 0.1 else 0,
        0 if n < 8 else -1 if together < 0.4 else 1 if together > 0.6 else 0,
        0 if n < 40 else -1 if pairs < 0.5 else 1 if pairs > 0.8 else 0,
        -1 if same > 0.3 else 1 if same < 0.1 else 0,
        0 if n < 40 else -1 if distinct < 0.08 else 1 if distinct > 0.25 else 0,
    )


class _Slots(dict):
    def __missing__(self, token: str) -> int:
        shape = "mark" + token[:1] * min(len(token), 3) if not token[0].isalnum() else "caps" if token.isupper() and len(token) > 1 else token.lower()
        self[token] = slot = zlib.crc32(shape.encode()) % (FEATURES - 2)
        return slot


_slots = _Slots()
kept_by(__name__, _slots.clear)


def features(batch: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all tokens, text by text, and their number: one slot each, and one if it repeats the last.

    Runs of marks and words in capitals share a slot by kind.
    """
    if len(_slots) > _KEPT_TOKENS:
        _slots.clear()
    counts = np.fromiter(map(len, batch), np.int64, len(batch))
    own = np.fromiter(map(_slots.__getitem__, chain.from_iterable(batch)), np.int64, int(counts.sum()))
    return own, counts


def rows_of(batch: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, weights) of each text: shares of its tokens, by the square root, and a constant."""
    own, counts = features(batch)
    ends = np.concatenate(([0], np.cumsum(counts)))
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        slots = own[a:b]
        repeated = np.count_nonzero(slots[1:] == slots[:-1])
        full = np.bincount(slots, minlength=FEATURES).astype(np.float64)
        full[FEATURES - 2] = repeated
        used = np.flatnonzero(full)
        yield np.append(used, FEATURES - 1), np.append(np.sqrt(full[used] / max(b - a, 1)), 1.0)


@dataclass(frozen=True)
class WeakModel:
    """Share of good documents, and each labeller's chance to vote -1 or 1, if it votes, on bad and good ones.

    A labeller that does not vote says nothing.
    """

    prior: float
    chances: np.ndarray

    def good(self, patterns: np.ndarray) -> np.ndarray:
        """Posterior chance that documents with these votes (one row each) are good."""
        logs = np.log(self.chances)
        bad, good = (patterns < 0).astype(float), (patterns > 0).astype(float)
        each = logs[:, :, 0] @ bad.T + logs[:, :, 1] @ good.T + np.log([[1 - self.prior], [self.prior]])
        return 1 / (1 + np.exp(np.clip(each[0] - each[1], -700, 700)))


def fit_votes(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> WeakModel:
    """Expectation-maximisation, with one imagined document for each vote.

    It starts from documents with two bad votes as bad and with none as good.
    """
    likely = np.choose(np.minimum((patterns < 0).sum(axis=1), 2), [0.95, 0.5, 0.05])
    hits = np.stack([patterns == v for v in (-1, 1)], axis=2).astype(float)
    model = None
    for _ in range(steps):
        sides = np.stack([(1 - likely) * counts, likely * counts])
        chances = np.einsum("sp,plv->slv", sides, hits) + 1.0
        chances /= chances.sum(axis=2, keepdims=True)
        prior = float(np.clip((sides[1].sum() + 1) / (counts.sum() + 2), 1e-6, 1 - 1e-6))
        model = WeakModel(prior, chances)
        new = model.good(patterns)
        moved, likely = np.abs(new - likely).max(initial=0), new
        if moved < 1e-9:
            break
    return model


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, ridge: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Weights of a logistic scorer for posterior labels, by accelerated gradient steps."""
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, (slots, values) in enumerate(rows):
        x[i, slots] = values
    w = ahead = np.zeros(FEATURES, np.float64)
    rate = 4.0 / (float((x**2).sum(axis=1).max(initial=0)) + ridge)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - rate * (x.T @ (p - good) / max(len(rows), 1) + ridge * ahead)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def _hashed(df: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    return df.select(whole).withColumn("h", F.xxhash64("text"))


def voted(df: DataFrame, text: str) -> DataFrame:
    """(pattern, n): how many different texts have each pattern of votes.

    Copies count once, or a text with a third of all rows would tell the labellers' worth. Each task sends a text's
    hash and pattern once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            names = []
            for s in slices(texts):
                names += ["".join("-0+"[v + 1] for v in votes(t, TOKEN.findall(t))) for t in texts[s]]
            yield pa.record_batch([batch.column("h"), pa.array(names, pa.string())], names=["h", "pattern"])

    different = arrow_map(_hashed(df, text), run, "h long, pattern string").distinct()
    return different.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def train(df: DataFrame, text: str = "text", sample: int = SAMPLE) -> np.ndarray | None:
    """The scorer's weights; None for an empty table.

    To the driver come the counts of at most 3 ** 7 patterns, and the features of ``sample`` different texts, those
    with the smallest hashes. With fewer texts than that, all are taken.
    """
    known = sorted((r["pattern"], r["n"]) for r in voted(df, text).collect())
    if not known:
        return None
    signs = {"-": -1, "0": 0, "+": 1}
    patterns = np.array([[signs[c] for c in p] for p, _ in known])
    counts = np.array([n for _, n in known], float)
    model = fit_votes(patterns, counts)
    # Hashes are even, so about twice as many texts as wanted pass, and never fewer but by a chance of 1e-20; then
    # the first are kept. Of copies one is drawn; each task sends one.
    share = min(1.0, (2.0 * sample + 200) / counts.sum())
    passing = _hashed(df, text).where(F.col("h") <= F.lit(min(int(share * 2**64) - 2**63, 2**63 - 1)))
    few = passing.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            for s in slices(texts):
                tokens = [TOKEN.findall(t) for t in texts[s]]
                rows = list(rows_of(tokens))
                yield pa.record_batch(
                    [
                        pa.array([votes(t, k) for t, k in zip(texts[s], tokens, strict=True)], pa.list_(pa.int32())),
                        pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                        pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                    ],
                    names=["votes", "slots", "values"],
                )

    got = sorted(arrow_map(few, run, "votes array<int>, slots array<long>, values array<double>").collect())
    rows = [(np.array(r["slots"]), np.array(r["values"])) for r in got]
    return fit_scorer(rows, model.good(np.array([r["votes"] for r in got]).reshape(-1, len(LABELLERS))))


def scored(df: DataFrame, weights: np.ndarray, text: str) -> DataFrame:
    """``df`` with a column ``_good``, the scorer's probability."""
    shared = weights.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, text)
            out = []
            for s in slices(texts):
                for slots, values in rows_of([TOKEN.findall(t) for t in texts[s]]):
                    out.append(1 / (1 + float(np.exp(-np.clip(shared[slots] @ values, -30, 30)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "_good"])

    return arrow_map(df, run, T.StructType([*df.schema.fields, T.StructField("_good", T.DoubleType())]))


def judged(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: id, score (chance to be good) and kept (score of at least 0.5).

    A null text is empty, and an empty text is bad by all votes. Equal texts have equal scores. Ids may be
    null or repeat. Copies of a text do not sway the scorer: it learns from different texts. A very long text takes
    part whole, alone in its step. An empty table gives no rows.
    """
    rows = df.select(df[f"`{id_column}`"].alias("id"), df[f"`{text}`"].alias("text"))
    weights = train(rows)
    if weights is None:
        weights = np.zeros(FEATURES)
    out = scored(rows, weights, "text").select("id", F.col("_good").alias("score"), (F.col("_good") >= CUT).alias("kept"))
    return out.withColumnRenamed("id", id_column)


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the scorer keeps, with all their columns."""
    weights = train(df.select(df[f"`{text}`"]), text)
    if weights is None:
        return df
    held = df.select(F.struct("*").alias("_doc"), df[f"`{text}`"].alias("text"))
    return scored(held, weights, "text").where(F.col("_good") >= CUT).select("_doc.*")
