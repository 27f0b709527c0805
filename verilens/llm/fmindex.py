"""An FM-index over stretches of words, with its symbols in a wavelet matrix.

The text is all stretches, each followed by a separator.  Its suffixes are
sorted by their first ``depth`` symbols, which is as deep as any search goes.
The last column is kept as bit planes with rank directories only (about log2 of
the alphabet bits for a word), not as symbols.  A backward search step maps the
two ends of a range of suffixes through the planes; steps run for many searches
at once.
"""

from __future__ import annotations

import numpy as np


class FMIndex:
    """Backward search over ``text`` (symbols from 1, separators 0)."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.n, sigma = n, int(text.max()) + 1 if n else 1
        last = text[_suffixes(text, depth) - 1]
        counts = np.bincount(text, minlength=sigma)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.planes = []
        for bit in reversed(range(max(1, (sigma - 1).bit_length()))):
            ones = (last >> bit & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, bool)
            padded[:n] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
            self.planes.append((bit, words, ranks, n - int(ones.sum())))
            last = np.concatenate([last[~ones], last[ones]])
        # where each symbol's entries start below the last plane
        self.first = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Positions of the top plane carried to below the last one, along each symbol's bits."""
        for bit, words, ranks, zeros in self.planes:
            word = at >> 6
            ones = ranks[word] + np.bitwise_count(words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(symbols >> bit & 1, zeros + ones, at - ones)
        return at

    def extended(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges [low, high) of suffixes with one more symbol before what they start with."""
        shift = self.before[symbols] - self.first[symbols]
        return self._down(symbols, low) + shift, self._down(symbols, high) + shift


def _suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the ``depth`` symbols that follow each (prefix doubling)."""
    rank, done = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while done < depth:
        ahead = np.zeros(len(text), np.int64)
        ahead[:-done or None] = rank[done:] + 1
        rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + ahead, return_inverse=True)[1].astype(np.int64)
        done *= 2
    return np.argsort(rank, kind="stable")


def _lowest(mask: np.ndarray) -> np.ndarray:
    return np.bitwise_count((mask & -mask) - 1).astype(np.int64)


def _highest(mask: np.ndarray) -> np.ndarray:
    return np.log2(mask.astype(np.float64)).astype(np.int64)  # masks of less than 50 bits


def _bits(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Masks with bits low to high set; none if high < low."""
    size = np.maximum(high - low + 1, 0)
    return np.where(size > 0, ((np.int64(1) << size) - 1) << np.maximum(low, 0), 0)


def repeated_windows(text: np.ndarray, starts: np.ndarray, windows: np.ndarray, known: np.ndarray, length: int) -> np.ndarray:
    """For each stretch a mask of its windows of ``length`` symbols that ``text`` holds more than once.

    ``starts``, ``windows``: where each stretch starts and how many windows it has (fewer
    than 50); ``known``: stretches all of whose windows are known to be repeated.
    A search goes back from an end as long as the match has two occurrences.  If it
    reaches the first open window, all windows up to the end are repeated.  If
    it stops before a symbol, no window that spans from there to the end is, and
    those that lie behind it are.  Ends are tried from the farthest, by halves."""
    index = FMIndex(text, int(windows.max(initial=0)) + length - 1)
    found = np.where(known, _bits(np.zeros_like(windows), windows - 1), 0)
    open_ = np.where(known, 0, _bits(np.zeros_like(windows), windows - 1))
    live = np.flatnonzero(open_)
    tries = np.zeros(len(live), np.int64)
    first, end = _begin(open_[live], tries, length)
    at, low, high = end.copy(), np.zeros(len(live), np.int64), np.full(len(live), index.n, np.int64)
    while len(live):
        new_low, new_high = index.extended(text[starts[live] + at - 1], low, high)
        more = new_high - new_low >= 2
        at = np.where(more, at - 1, at)
        reached = more & (at == first)
        low, high = new_low, new_high
        over = np.flatnonzero(reached | ~more)
        if not len(over):
            continue
        who, last = live[over], end[over] - length
        stop = at[over] - 1  # the symbol that made the match unique
        hit = np.where(reached[over], _bits(first[over], last), _bits(stop + 1, last)) & open_[who]
        miss = np.where(reached[over], 0, _bits(np.maximum(last, 0), stop)) & open_[who]
        found[who] |= hit
        open_[who] &= ~(hit | miss)
        same = open_[who] >> first[over] & 1
        tries[over] = np.where(same, tries[over] + 1, 0)
        going = open_[who] != 0
        again = over[going]
        if len(again):
            first[again], end[again] = _begin(open_[live[again]], tries[again], length)
            at[again], low[again], high[again] = end[again], 0, index.n
        if not going.all():
            stay = np.ones(len(live), bool)
            stay[over[~going]] = False
            live, tries, first, end, at, low, high = (x[stay] for x in (live, tries, first, end, at, low, high))
    return found


def _begin(open_: np.ndarray, tries: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first open window, end of the search) of each stretch."""
    first, last = _lowest(open_), _highest(open_)
    return first, first + length + ((last - first) >> np.minimum(tries, 62))
