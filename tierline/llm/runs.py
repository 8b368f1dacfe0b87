"""Periodic runs: stretches of words that repeat with a period, found through suffix arrays.

The suffix array of a batch of texts comes from prefix doubling. Every text has symbols of its own, so suffixes of
different texts share no prefix and one array serves the whole batch. The ranks of each doubling step are kept: they
tell in one comparison whether two stretches of 1, 2, 4, ... words are equal.

For each LCP interval of depth d, the suffixes of its smaller side are tested: suffix i and suffix i + d (or i - d)
on the other side of the split make a square of period d that the next word does not carry on. Each run has exactly
one such square, at its right end. Rotating it to the left, by the kept ranks in leaps, gives the run's start;
squares of the same stretch merge into the one of the smallest period. No tree is built.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import arrow_map, mixed, slices, texts_of

# A run has at least this many words, and its period this many times.
LEAST_WORDS = 6
LEAST_PERIODS = 4

#: Words are what stands between these characters.
BLANKS = r"\x20\x09-\x0D"
_WORD = re.compile(rf"[^{BLANKS}]+")
#: Suffixes tested at once.
_TESTED = 1 << 20
#: Words that equal shingles of the filter have.
_FILTER = 4

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _ids(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 1 for all words, equal for equal words, and the number of words of each text."""
    known: dict[str, int] = {}
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((known.setdefault(w, len(known) + 1) for ws in lists for w in ws), np.int64, int(counts.sum()))
    return flat, counts


def _may_repeat(flat: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Texts in which some ``length`` words may occur twice; false only if none do."""
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    h = flat.astype(np.uint64)
    for j in range(1, length):
        h[:-j] = mixed(h[:-j] * np.uint64(31) + flat[j:].astype(np.uint64))
    inside = np.ones(len(flat), bool)
    inside[1 - length :] = False
    inside[: 1 - length] &= owner[: 1 - length] == owner[length - 1 :]
    keys = np.sort((owner[inside] << np.uint64(40)) | (mixed(h[inside]) >> np.uint64(24)))
    out = np.zeros(len(counts), bool)
    out[(keys[1:][keys[1:] == keys[:-1]] >> np.uint64(40)).astype(np.int64)] = True
    return out


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The suffix array, the common prefix of each suffix with the one before, and ranks by 1, 2, 4, ... symbols.

    Every text must end in a symbol of its own, and texts must share no symbols.
    """
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    in_order = symbols[sa]
    new = np.concatenate(([True], in_order[1:] != in_order[:-1]))
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    lcp = np.zeros(n, np.int64)
    ranks, step = [rank], 1
    single = new & np.concatenate((new[1:], [True]))
    tied = np.flatnonzero(~single)
    while len(tied):
        at = sa[tied]
        key = rank[at].astype(np.int64) * n + rank[at + step]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[tied] = at
        new = np.concatenate(([True], key[1:] != key[:-1]))
        before = rank[at]
        split = new & np.concatenate(([False], before[1:] == before[:-1]))
        a, b = sa[tied[split] - 1], sa[tied[split]]
        common = np.full(len(a), step, np.int64)
        for j in range(len(ranks) - 2, -1, -1):
            common += (ranks[j][a + common] == ranks[j][b + common]).astype(np.int64) << j
        lcp[tied[split]] = common
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        ranks.append(rank)
        tied = tied[~(new & np.concatenate((new[1:], [True])))]
        step *= 2
    return sa, lcp, ranks


def _sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the last place before with a smaller value, and the next with one not greater."""
    values, n = lcp.tolist(), len(lcp)
    left, right, stack = [0] * n, [n] * n, []
    for k, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = k
        same = stack and values[stack[-1]] == v
        if same:
            right[j := stack.pop()] = k
            left[k] = left[j]
        else:
            left[k] = stack[-1] if stack else 0
        stack.append(k)
    return np.array(left), np.array(right)


def _squares(sa: np.ndarray, lcp: np.ndarray, deepest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of all squares that the word behind them ends; periods up to ``deepest`` of the place."""
    n = len(sa)
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    left, right = _sides(lcp)
    splits = np.flatnonzero((lcp > 0) & (lcp <= deepest[sa]))
    low, high, depth = left[splits], right[splits], lcp[splits]
    left_is_smaller = splits - low <= high - splits
    first = np.where(left_is_smaller, low, splits)
    sizes = np.where(left_is_smaller, splits - low, high - splits)
    other = np.where(left_is_smaller, splits, low), np.where(left_is_smaller, high, splits)
    places, periods = [], []
    ends = np.cumsum(sizes)
    start = 0
    while start < len(splits):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + _TESTED, "right")))
        size = sizes[start:stop]
        which = np.repeat(np.arange(start, stop), size)
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        suffix, d = sa[first[which] + within], depth[which]
        for place in (suffix, suffix - d):
            partner = suffix + d if place is suffix else place
            at = isa[np.clip(partner, 0, n - 1)]
            hit = (partner >= 0) & (at >= other[0][which]) & (at < other[1][which])
            places.append(place[hit])
            periods.append(d[hit])
        start = stop
    return np.concatenate([np.empty(0, np.int64), *places]), np.concatenate([np.empty(0, np.int64), *periods])


def text_runs(
    lists: list[list[str]], least: int = LEAST_WORDS, power: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of lists of words, by text, start and period."""
    nothing = (np.empty(0, np.int64),) * 4
    flat, counts = _ids(lists)
    # A run repeats all but its first period, so some stretch of so many words occurs twice.
    repeated = min(max(least - q, (power - 1) * q, 1) for q in range(1, least + 1))
    # Word lists of fewer words hold no run.
    open_ = counts >= max(least, power)
    if repeated >= _FILTER and len(flat) >= _FILTER:
        open_ &= _may_repeat(flat, counts, _FILTER)
    if not open_.any():
        return nothing
    flat, texts, counts = flat[np.repeat(open_, counts)], np.flatnonzero(open_), counts[open_]
    owner = np.repeat(np.arange(len(counts)), counts)
    # Symbols: the texts one after the other, each with its own words (1, 2, ...) and its own end (0).
    symbols = np.empty(len(flat) + len(counts), np.int64)
    base = np.arange(len(counts)) * (int(flat.max()) + 1)
    symbols[np.arange(len(flat)) + owner] = flat + base[owner]
    begin = np.cumsum(counts + 1) - counts - 1
    symbols[begin + counts] = base
    sa, lcp, ranks = suffix_order(symbols)
    at, period = _squares(sa, lcp, np.repeat(counts // power, counts + 1))
    start = at.copy()
    for j in range(len(ranks) - 1, -1, -1):
        back = start - (1 << j)
        safe = np.maximum(back, 0)
        start = np.where((back >= 0) & (ranks[j][safe] == ranks[j][safe + period]), back, start)
    length = at + 2 * period - start
    keep = length >= np.maximum(least, power * period)
    start, length, period = start[keep], length[keep], period[keep]
    # The same stretch turns up with multiples of its period too.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[smallest], length[smallest], period[smallest]
    text = np.searchsorted(begin, start, "right") - 1
    out = texts[text], start - begin[text], length, period
    order = np.lexsort((out[3], out[1], out[0]))
    return tuple(c[order] for c in out)


def _collapsed(words: list[str], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    """The words that no run repeats, joined by one space."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return " ".join([w for w, d in zip(words, np.cumsum(depth).tolist()) if not d])


def find_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, power: int = LEAST_PERIODS
) -> DataFrame:
    """(key, n_words, runs, collapsed): the periodic runs of every whole text, one row for each row of ``docs``.

    A run is a stretch of words with smallest period q, at least ``least`` words and ``power`` (2 or more) periods
    long, that neither neighbouring word carries on. ``runs`` holds (start, length, period) in words from 0, by start,
    then period. ``collapsed`` is the text without the words that a run holds after its first period, joined by one
    space. Null and empty texts have no words, no runs and an empty ``collapsed``. Repeated rows, null keys and
    clashing or further columns do no harm: each row is judged by itself, and only the two columns named are read.

    There is no shuffle; a task holds some 2 million characters at once, or one longer text, at about 150 bytes a word.
    """
    if power < 2 or least < 2:
        raise ValueError("a run has at least two words and two periods")
    id_type = docs.schema[key].dataType
    schema = T.StructType(
        [T.StructField("_key", id_type), T.StructField("n_words", T.LongType()),
         T.StructField("runs", T._parse_datatype_string(RUNS)), T.StructField("collapsed", T.StringType())]
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "_text")
            for part in slices(texts):
                lists = [_WORD.findall(t) for t in texts[part]]
                of, *spans = text_runs(lists, least, power)
                bounds = np.searchsorted(of, np.arange(len(lists) + 1))
                collapsed = []
                for words, a, b in zip(lists, bounds[:-1].tolist(), bounds[1:].tolist()):
                    collapsed.append(_collapsed(words, *(s[a:b] for s in spans)) if b > a else " ".join(words))
                runs = pa.StructArray.from_arrays([pa.array(s, pa.int64()) for s in spans], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key")[part.start : part.stop], pa.array(map(len, lists), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs), pa.array(collapsed, pa.string())],
                    ["_key", "n_words", "runs", "collapsed"],
                )

    found = arrow_map(docs.select(docs[f"`{key}`"].alias("_key"), docs[f"`{text}`"].alias("_text")), judged, schema)
    return found.withColumnRenamed("_key", key)


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by the checksum of its id, repeats a part of itself up to its end.

    With h = crc32 of the id in decimal, g = floor(h / 10) and n words: if h % 10 = 0, each word i from a = g % n on
    becomes word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). Texts with a null id, and texts
    without words, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", rf"[{BLANKS}]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", (h / 10).cast("bigint").alias("_g"), F.when(h % 10 == 0, words).alias("_w"))
    n = F.size("_w")
    a = (F.col("_g") % n).cast("int")
    p = F.lit(1) + ((n - a) / (3 + F.col("_g") % 8)).cast("int")
    tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get("_w", a + i % p))
    changed = F.array_join(F.concat(F.slice("_w", F.lit(1), a), tail), " ")
    return chosen.select("doc_id", F.when(n > 0, changed).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Of ``find_runs``: the number of runs, the longest (ties: smallest start, then period), and digests."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("_l", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_l.s")).alias("start"),
        F.col("_l.l").alias("length"),
        (-F.col("_l.p")).alias("period"),
        F.expr("(1000 * _l.l) div (-_l.p)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
