"""Class-conditional Kneser-Ney models of bytes within words, over sorted tables of n-grams."""

from __future__ import annotations

import numpy as np

DISCOUNT = 0.75
BOUNDARY = 32
#: Words of more bytes are cut into parts of this length, so that no single word rules a task's memory.
LONGEST = 64


def cut_words(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Parts of at most LONGEST bytes of all words, and the number of parts of each word."""
    parts = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return parts, np.array([-(-len(w) // LONGEST) for w in words], np.int64)


def layout(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, word numbers, lengths): every position's n-gram as one number, highest byte first."""
    pad = bytes([BOUNDARY]) * (order - 1)
    stream = np.frombuffer(b"".join(pad + w + bytes([BOUNDARY]) for w in words), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    number = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths + order - 1) - lengths - (order - 1)
    at = np.arange(len(number)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    grams = np.zeros(len(number), np.int64)
    for k in range(order):
        grams = (grams << 8) | stream[at + k]
    return grams, number, lengths


class KneserNey:
    """Both classes' models over one table of n-grams; counts has a column per class. N-grams without counts change
    nothing. The levels go down to order ``least``: ``rest`` are the n-grams and counts of the order below, and
    ``base`` is the model of that order (none: all bytes alike)."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int, shared: int = 2, least: int = 1, base: KneserNey | None = None):
        sort = np.argsort(grams)
        grams, counts = grams[sort], counts[sort].astype(np.float64)
        self.order, self.shared, self.least, self.base, self.levels = order, shared, least, base, []
        for n in range(order, least - 1, -1):
            used = np.repeat(counts.sum(axis=1, keepdims=True), 2, axis=1) if n <= shared else counts
            context, place = np.unique(grams >> 8, return_inverse=True)
            total = np.stack([np.bincount(place, used[:, c], len(context)) for c in (0, 1)], axis=1)
            kinds = np.stack([np.bincount(place, used[:, c] > 0, len(context)) for c in (0, 1)], axis=1)
            safe = np.maximum(total, 1e-12)
            own = np.maximum(used - DISCOUNT, 0) / safe[place]
            weight = np.where(total > 0, np.minimum(DISCOUNT * kinds / safe, 1.0), 1.0)
            self.levels.append((grams, own, context, weight))
            if n > 1:
                # Continuation counts: different bytes before; n-grams at a word's start have no byte before.
                tail = grams & ((1 << 8 * (n - 1)) - 1)
                start = (grams >> 8 * (n - 1)) == BOUNDARY
                value = np.where(start[:, None] & (((tail >> 8 * (n - 2)) == BOUNDARY)[:, None]), counts, counts > 0)
                grams, place = np.unique(tail, return_inverse=True)
                counts = np.stack([np.bincount(place, value[:, c], len(grams)) for c in (0, 1)], axis=1)
        self.rest, self.known = (grams, counts), self.levels[0][0]
        self.ratio = self._ratios(self.known) if least == 1 or base is not None else None

    @classmethod
    def from_levels(cls, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], shared: int) -> KneserNey:
        """A model from the tables of all its levels, the highest order first."""
        self = cls.__new__(cls)
        self.order, self.least, self.shared, self.base, self.levels = len(levels), 1, shared, None, levels
        self.known = levels[0][0]
        self.ratio = self._ratios(self.known)
        return self

    def _chances(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(last byte | bytes before) in both classes, and that of the shared backoff."""
        p = np.full((len(grams), 2), 1 / 256) if self.base is None else self.base._chances(grams)[0]
        backoff = p[:, 0].copy()
        for n, (table, own, contexts, weight) in zip(range(self.least, self.order + 1), reversed(self.levels)):
            gram = grams & ((1 << 8 * n) - 1)
            at, found = _place(contexts, gram >> 8)
            p = np.where(found[:, None], weight[at], 1.0) * p
            at, found = _place(table, gram)
            p += np.where(found[:, None], own[at], 0.0)
            if n == self.shared:
                backoff = p[:, 0].copy()
        return p, backoff

    def _ratios(self, grams: np.ndarray) -> np.ndarray:
        """log P(last byte | bytes before, toxic) - log P(same, ordinary), the latter not less than the backoff's."""
        p, backoff = self._chances(grams)
        return np.log(p[:, 1]) - np.log(np.maximum(p[:, 0], backoff))

    def words(self, words: list[bytes]) -> np.ndarray:
        """The log ratio of each word."""
        if not words:
            return np.zeros(0)
        grams, number, _ = layout(words, self.order)
        at, found = _place(self.known, grams)
        ratio = self.ratio[at]
        if not found.all():
            rare, back = np.unique(grams[~found], return_inverse=True)
            ratio[~found] = self._ratios(rare)[back]
        return np.bincount(number, ratio, len(words))


def _place(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values
