"""SentencePiece encoding by suffix-array matching, and decoding.

For a batch, the distinct words (a run of word marks and what follows up to the next) are
concatenated into one text and its suffixes are sorted by as many code points as the longest
piece has. Binary search of all pieces gives every occurrence of each: the edges. Edges are sorted
by position and relaxed word by word.

The model is of the BPE kind, whose result is not the best sum of scores but what the merges
leave. So an edge is relaxed by the rule that makes both the same: it extends the path to
its start only if the merges, applied to the last piece of that path and the new piece alone,
leave just these two. For each position one edge at most passes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import arrow_map, kept_by, mixed, slices, texts_of
from tierline.llm.pool import PiecePool, runs, starts_of

MARK = "▁"
#: Slots for the pairs of pieces that a worker knows, a power of two; a pair that meets a taken slot takes it over. Only speed depends on it.
KEPT_PAIRS = 1 << 20
#: Code points of new words whose suffixes are sorted at once, which bounds a batch's arrays. Only memory and speed depend on it.
SORTED_AT_ONCE = 150_000
#: Code points of texts that a task encodes at once.
ENCODED_CHARS = 500_000
#: What stands before a position: no path, or a start where any piece fits.
NOWHERE, ANY = -2, -1


class Pieces(PiecePool):
    """The vocabulary of a BPE model with byte fallback, as read by the sentencepiece library."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        super().__init__(np.dtype(np.int32))
        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.byte = {int(self.text[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        skip = self.special | set(self.byte.values())
        #: What each id adds to a decoded text.
        self.encoded = [b"" if i in self.special else p.encode() for i, p in enumerate(self.text)]
        for b, i in self.byte.items():
            self.encoded[i] = bytes([b])
        self.rank = {self.text[i]: -sp.get_score(i) for i in range(n) if i not in skip}
        self.id = {self.text[i]: i for i in range(n) if i not in skip}
        spans = [p for p in self.id if MARK in p.lstrip(MARK)]
        if spans:
            raise ValueError(f"pieces that reach over a word mark are not supported: {spans[:3]}")
        #: Pieces that merges can make; only these are edges.
        past = {p: self.history(p) for p in self.id}
        self.pieces = sorted(p for p in self.id if past[p][0] == [p])
        self.past = [past[p] for p in self.pieces]
        self.longest = max(map(len, self.pieces))
        self.pair, self.pair_fits = np.full(KEPT_PAIRS, -1, np.int64), np.zeros(KEPT_PAIRS, bool)
        codes = np.zeros((len(self.pieces), self.longest), np.uint32)
        for i, p in enumerate(self.pieces):
            codes[i, : len(p)] = np.frombuffer(p.encode("utf-32-le"), np.uint32)
        self.letters, self.sizes = codes, np.array([len(p) for p in self.pieces])
        self.number = np.array([self.id[p] for p in self.pieces], np.int32)

    def history(self, text: str) -> tuple[list[str], list[float], list[str], list[str]]:
        """What merging leaves of a short text (the best pair first, of equals the leftmost).

        Also the rank of each merge, then infinity, and the first and last part before each of these.
        """
        parts = list(text)
        ranks, firsts, lasts = [], [], []
        while True:
            each = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(each, default=np.inf)
            ranks.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
            if best == np.inf:
                return parts, ranks, firsts, lasts
            at = each.index(best)
            parts[at : at + 2] = [intern(parts[at] + parts[at + 1])]

    def fit(self, left: int, right: int) -> bool:
        """Whether merging both pieces' text leaves just the two: no merge reaches over the border.

        Until one does, each side merges as it does alone, so its history tells what meets there.
        """
        _, ranks_l, _, lasts = self.past[left]
        _, ranks_r, firsts, _ = self.past[right]
        rank, i, j = self.rank, 0, 0
        while True:
            over, l, r = rank.get(lasts[i] + firsts[j], np.inf), ranks_l[i], ranks_r[j]
            if over < l and over <= r:
                return False
            if l <= r:
                if l == np.inf:
                    return True
                i += 1
            else:
                j += 1

    def fits(self, keys: np.ndarray) -> np.ndarray:
        """Whether merging leaves the two pieces of each key (left * number of pieces + right) as they are."""
        n = len(self.pieces)
        slot = (mixed(keys.astype(np.uint64)) % np.uint64(KEPT_PAIRS)).astype(np.int64)
        good, new = self.pair_fits[slot], np.flatnonzero(self.pair[slot] != keys)
        if len(new):
            distinct, one, back = np.unique(keys[new], return_index=True, return_inverse=True)
            found = np.fromiter((self.fit(k // n, k % n) for k in distinct.tolist()), bool, len(distinct))
            good[new] = found[back]
            taken, last = np.unique(slot[new[one]], return_index=True)
            self.pair[taken], self.pair_fits[taken] = distinct[last], found[last]
        return good

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(position, index of piece) of every occurrence of every piece, by position, longest first."""
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        depth = self.longest
        letters = np.unique(code)
        bits = len(letters).bit_length()
        head, wide = packed(np.searchsorted(letters, code) + 1, bits, depth)
        order = suffixes(head, depth, wide)
        # Pieces by what their first code points pack to; one that has a letter the text lacks is nowhere.
        at = np.minimum(np.searchsorted(letters, self.letters), len(letters) - 1)
        used = np.arange(depth) < self.sizes[:, None]
        which = np.flatnonzero(((letters[at] == self.letters) | ~used).all(axis=1))
        numbers = np.where(used, at + 1, 0)[which, :wide]
        low = np.zeros(len(which), np.int64)
        for j in range(wide):
            low = (low << bits) | (numbers[:, j] if j < depth else 0)
        free = bits * np.maximum(wide - self.sizes[which], 0)
        heads = head[order]
        first = np.searchsorted(heads, low)
        after = np.searchsorted(heads, low + (1 << free) - 1, side="right")
        # Longer pieces are looked up where their first code points are.
        long = np.flatnonzero((self.sizes[which] > wide) & (first < after))
        padded = np.concatenate((code, np.zeros(depth, np.uint32)))
        bounds = [self.bound(which[long], first[long], after[long], order, padded, right) for right in (False, True)]
        first[long], after[long] = bounds
        counts = after - first
        start = order[runs(first, counts)]
        which = np.repeat(which, counts)
        by_place = np.argsort(start * (depth + 1) + depth - self.sizes[which])
        return start[by_place], which[by_place]

    def bound(self, which: np.ndarray, low: np.ndarray, high: np.ndarray, order: np.ndarray, padded: np.ndarray, right: bool) -> np.ndarray:
        """Where the suffixes that begin with each piece begin (``right``: end) in their order, between two bounds."""
        while (open_ := low < high).any():
            mid = np.minimum((low + high) // 2, len(order) - 1)
            at = order[mid]
            less, equal = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for j in range(self.longest):
                inside = equal & (j < self.sizes[which])
                if not inside.any():
                    break
                here, want = padded[at + j], self.letters[which, j]
                less |= inside & (here < want)
                equal &= ~inside | (here == want)
            go = open_ & (less | (equal if right else False))
            low = np.where(go, mid + 1, low)
            high = np.where(open_ & ~go, mid, high)
        return low

    def ids_of_new(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.ids_at_once(new[s]) for s in slices(new, SORTED_AT_ONCE)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])

    def ids_at_once(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\n".join(new) + "\n"
        start, which = self.edges(text)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        begins = starts_of(sizes + 1)
        place = np.arange(len(text)) - np.repeat(begins, sizes + 1)
        last = np.full(len(text), NOWHERE, np.int64)
        back = np.zeros(len(text), np.int64)
        last[begins] = ANY
        bare = np.repeat(sizes, sizes + 1) > place
        bare[start[self.sizes[which] == 1]] = False
        # Small numbers are sorted by radix.
        by_place = np.argsort(place[start].astype(np.min_scalar_type(int(sizes.max()))), kind="stable")
        start, which = start[by_place], which[by_place]
        steps = np.searchsorted(place[start], np.arange(sizes.max() + 1))
        unknown = np.flatnonzero(bare)
        for at, (lo, hi) in enumerate(zip(steps[:-1], steps[1:], strict=True)):
            s, w = start[lo:hi], which[lo:hi]
            before = last[s]
            good = before == ANY
            linked = np.flatnonzero(before >= 0)
            good[linked] = self.fits(before[linked] * len(self.pieces) + w[linked])
            s, w = s[good], w[good]
            ends = s + self.sizes[w]
            last[ends], back[ends] = w, s
            for u in unknown[place[unknown] == at]:
                last[u + 1], back[u + 1] = ANY, u
        paths, now = [], begins + sizes
        while len(now):
            paths.append(now)
            now = back[now]
            now = now[place[now] > 0]
        ends = np.sort(np.concatenate(paths))
        counts = np.bincount(np.searchsorted(begins, ends, side="right") - 1, minlength=len(new))
        piece = last[ends]
        ids = np.where(piece >= 0, self.number[piece], ANY).astype(np.int32)
        if (ids == ANY).any():
            spelt = [[self.byte[b] for b in text[e - 1].encode()] if i == ANY else [i] for i, e in zip(ids.tolist(), ends.tolist(), strict=True)]
            widths = np.fromiter(map(len, spelt), np.int64, len(spelt))
            counts = np.add.reduceat(widths, starts_of(counts))
            ids = np.array([i for x in spelt for i in x], np.int32)
        return ids, counts

    def split(self, text: str) -> list[str]:
        return word_runs(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, counts = self.ids(texts)
        return np.split(flat, np.cumsum(counts)[:-1]) if texts else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes are put together, marks become spaces, the added first one goes."""
        raw = b"".join([self.encoded[i] for i in ids])
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def word_runs(text: str) -> list[str]:
    """The text with its first mark, cut before each run of marks."""
    if not text:
        return []
    rest = text.replace(MARK, " ").split(" ")
    if all(rest):
        return [MARK + r for r in rest]
    out, marks = [], 0
    for r in rest:
        marks += 1
        if r:
            out.append(MARK * marks + r)
            marks = 0
    return out + [MARK * marks] if marks else out


def packed(numbers: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, int]:
    """At each position the numbers (from 1, of ``bits`` bits) from there on, the first highest, as many as fit and a
    power of two up to the one that covers ``depth``; also how many. Behind the end are zeros.
    """
    out, width = numbers.astype(np.int64), 1
    while width < depth and 2 * width * bits < 63:
        ahead = np.zeros_like(out)
        ahead[:-width] = out[width:]
        out = (out << (bits * width)) | ahead
        width *= 2
    return out, width


def suffixes(head: np.ndarray, depth: int, width: int = 1) -> np.ndarray:
    """Positions in the order of the suffixes there, told apart by at least ``depth`` code points.

    ``head`` holds numbers in the order of the first ``width`` code points. Equal suffixes come in any order.
    """
    rank = head.astype(np.int64)
    order = np.argsort(rank)
    while width < depth:
        ordered = rank[order]
        rank = np.empty_like(rank)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1]))) + 1
        ahead = np.zeros_like(rank)
        ahead[:-width] = rank[width:]
        rank = rank * (len(head) + 2) + ahead
        order = np.argsort(rank)
        width *= 2
    return order


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


kept_by(__name__, pieces.cache_clear)


def encoded(df: DataFrame, model: str, id_column: str = "doc_id", text: str = "text", kept: int = PiecePool.kept) -> DataFrame:
    """One row for each row of ``df``: id, ids (the pieces of the whole text), n_ids, ids_crc32, decoded_ok.

    ``decoded_ok`` says that decoding gives the text back. It does not where a text holds the word
    mark itself, which decodes to a space. A null text is an empty one and has no ids. Ids of rows may be
    null or repeat. No shuffle; a task holds one slice of a batch, or one long text, at a time. A worker knows about
    ``kept`` words between batches: fewer take less memory and more time.
    """
    schema = "id long, ids array<int>, n_ids long, ids_crc32 long, decoded_ok boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_pieces = pieces(model)
        model_pieces.kept = kept
        for batch in batches:
            texts, names = texts_of(batch, "text"), batch.column("id")
            for s in slices(texts, ENCODED_CHARS):
                flat, counts = model_pieces.ids(texts[s])
                ends = np.concatenate(([0], np.cumsum(counts)))
                each = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.record_batch(
                    [
                        names[s.start : s.stop],
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                        pa.array(counts),
                        pa.array([zlib.crc32(e.astype("<u4").tobytes()) for e in each], pa.int64()),
                        pa.array([model_pieces.decode(e.tolist()) == t for e, t in zip(each, texts[s], strict=True)]),
                    ],
                    names=["id", "ids", "n_ids", "ids_crc32", "decoded_ok"],
                )

    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return arrow_map(rows, run, schema).withColumnRenamed("id", id_column)
