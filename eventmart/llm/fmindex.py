"""An FM-index over a sequence of small integers: a wavelet matrix over its Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

# Symbol 0 ends the sequence, symbol 1 separates runs and never matches; patterns use 2 and up.
END, GAP = 0, 1


def suffix_order(text: np.ndarray, bits: int, run_left: np.ndarray) -> np.ndarray:
    """Suffixes in order. Each is compared up to its first gap only; equal ones stay in text order.

    `run_left` has the number of symbols before the next gap. Symbols are packed into words, and ties
    that go on past those are resolved by doubling.
    """
    n = len(text)
    per_word = max(1, 62 // bits)
    padded = np.concatenate([text, np.zeros(per_word, text.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(per_word):
        key = (key << np.uint64(bits)) | np.where(run_left >= k, padded[k : k + n], np.uint64(0))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n, np.int64)
    heads = np.flatnonzero(fresh)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    step = per_word
    # Ties that end at a gap within `step` symbols are final: text order decides.
    group_of = rank[order]
    tied = np.zeros(n, bool)
    tied[1:] |= group_of[1:] == group_of[:-1]
    tied[:-1] |= group_of[1:] == group_of[:-1]
    slots = np.flatnonzero(tied & (run_left[order] >= step))
    while len(slots):
        rows = order[slots]
        follow = rows + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        # What follows begins at a gap where the run has ended: all such are equal.
        second = np.where(run_left[rows] == step, -1, second)
        by = np.lexsort((rows, second, rank[rows]))
        rows, second = rows[by], second[by]
        order[slots] = rows
        first = rank[rows]
        fresh = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        heads = np.flatnonzero(fresh)
        spread = np.repeat(slots[heads], np.diff(np.append(heads, len(rows))))
        rank[rows] = spread
        step *= 2
        same = np.zeros(len(rows), bool)
        same[1:] |= ~fresh[1:]
        same[:-1] |= ~fresh[1:]
        slots = slots[same & (run_left[rows] >= step)]
    return order


class FMIndex:
    """Find every occurrence of many patterns in one sequence.

    Patterns are searched backwards, all at once. Suffix positions are kept for every `sample`-th symbol
    of a run and its first; the others are reached by walking back.
    """

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        """`text` ends with END; runs are set apart by GAP."""
        n = len(text)
        self.n, self.bits = n, max(2, int(symbols - 1).bit_length())
        stops = np.flatnonzero(text <= GAP)
        run_left = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)
        order = suffix_order(text, self.bits, run_left)
        before = text[order - 1]
        self.first = np.searchsorted(text[order], np.arange(symbols + 1))
        self._levels(before)
        starts = np.concatenate([[0], stops[:-1] + 1])
        into_run = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        sampled = (into_run % sample == 0)[order]
        self.sampled, self.sampled_rank = self._packed(sampled)
        self.positions = order[sampled]

    @staticmethod
    def _packed(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        raw[: len(packed)] = packed
        words = raw.view(np.uint64)
        return words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])

    @staticmethod
    def _ones(level: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        words, ranks = level
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return ranks[word] + np.bitwise_count(words[word] & below)

    def _levels(self, values: np.ndarray) -> None:
        self.levels, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            is_one = (values >> bit) & 1 == 1
            self.levels.append(self._packed(is_one))
            self.zeros.append(int(len(values) - is_one.sum()))
            values = np.concatenate([values[~is_one], values[is_one]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each position."""
        begin = np.zeros_like(at)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbols >> (self.bits - 1 - k)) & 1 == 1
            ones_begin, ones_at = self._ones(level, begin), self._ones(level, at)
            begin = np.where(one, zeros + ones_begin, begin - ones_begin)
            at = np.where(one, zeros + ones_at, at - ones_at)
        return at - begin

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position of the transform, and how often it stands before."""
        symbol, begin = np.zeros_like(at), np.zeros_like(at)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            ones, ones_next = self._ones(level, at), self._ones(level, at + 1)
            one = ones_next > ones
            ones_begin = self._ones(level, begin)
            begin = np.where(one, zeros + ones_begin, begin - ones_begin)
            at = np.where(one, zeros + ones, at - ones)
            symbol = (symbol << 1) | one
        return symbol, at - begin

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each pattern. Patterns are left-aligned rows."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        alive = np.arange(len(lengths))
        for back in range(int(lengths.max(initial=0))):
            alive = alive[lengths[alive] > back]
            if not len(alive):
                break
            symbols = patterns[alive, lengths[alive] - 1 - back]
            start = self.first[symbols]
            low[alive] = start + self.rank(symbols, low[alive])
            high[alive] = start + self.rank(symbols, high[alive])
            done = high[alive] <= low[alive]
            high[alive[done]] = low[alive[done]]
            # Those found whole stay found; only the ones still matching go on.
            alive = alive[~done]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of rows whose suffix begins inside a run."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            word, inside = at[todo] >> 6, (at[todo] & 63).astype(np.uint64)
            todo = todo[(self.sampled[word] >> inside) & np.uint64(1) == 0]
            if not len(todo):
                break
            symbol, rank = self.symbol_and_rank(at[todo])
            at[todo] = self.first[symbol] + rank
            steps[todo] += 1
        return self.positions[self._ones((self.sampled, self.sampled_rank), at)] + steps
