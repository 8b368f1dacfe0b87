"""Ids of texts from the ids of their pieces, each distinct piece encoded once by a worker."""

from __future__ import annotations

from itertools import chain

import numpy as np


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, one run after another."""
    skip = starts - starts_of(lengths)
    return np.repeat(skip, lengths) + np.arange(int(lengths.sum()))


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))[:-1]


class _Numbers(dict):
    """Numbers pieces in the order they are met first, and lists the new ones."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class PiecePool:
    """Subclasses say how a text is split and what the ids of new pieces are.

    ``kept`` bounds the pieces in memory between calls; only speed depends on it.
    """

    kept = 600_000

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.codes = _Numbers({})
        self._reset(np.zeros(0, dtype), np.zeros(0, np.int64))

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def ids_of_new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, piece by piece, and their number for each piece."""
        raise NotImplementedError

    def _reset(self, pool: np.ndarray, lengths: np.ndarray) -> None:
        self.pool, self.lengths = pool, lengths
        self.uses = np.zeros(len(lengths), np.int64)

    def _shrink(self) -> None:
        """Keep the pieces met more than once, or as often as leaves half of what may be kept."""
        least = 1
        while (keep := self.uses > least).sum() > self.kept // 2:
            least *= 2
        number = np.cumsum(keep) - 1
        self.codes = _Numbers({p: int(number[c]) for p, c in self.codes.items() if keep[c]})
        lengths = self.lengths[keep]
        self._reset(self.pool[runs(starts_of(self.lengths)[keep], lengths)], lengths)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text by text, and the number of ids of each text."""
        if len(self.codes) > self.kept:
            self._shrink()
        codes = self.codes
        pieces = [self.split(t) for t in texts]
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        at = np.fromiter(map(codes.__getitem__, chain.from_iterable(pieces)), np.int64, int(counts.sum()))
        if new := codes.new:
            codes.new = []
            flat, lengths = self.ids_of_new(new)
            self.pool = np.concatenate((self.pool, flat))
            self.lengths = np.concatenate((self.lengths, lengths))
            self.uses = np.concatenate((self.uses, np.zeros(len(new), np.int64)))
        self.uses += np.bincount(at, minlength=len(self.uses))
        lengths = self.lengths[at]
        total = np.concatenate(([0], np.cumsum(lengths)))
        ends = np.concatenate(([0], np.cumsum(counts)))
        return self.pool[runs(starts_of(self.lengths)[at], lengths)], np.diff(total[ends])
