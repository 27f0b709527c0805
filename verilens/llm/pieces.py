"""Token ids of whole texts, with the work done once for each distinct piece.

Both byte-level tokenizers here cut a text before white space that follows
something else, and after an ASCII letter that another ASCII character than a
letter follows.  A text may therefore be cut at these places (no others are
needed) and its pieces encoded on their own: the ids of the text are those of
its pieces, in order.  The pieces of a batch are named by one dictionary code
each; what a worker has encoded stays in a cache of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from verilens.llm.textbatch import ALPHA, SPACE, as_strings, flat, named, segment_sum, spread

#: Pieces that one worker's cache holds at most; more are encoded again in each batch.
CACHED_PIECES = 200_000
#: Longer pieces aren't kept.
CACHED_BYTES = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_OTHER = ~ALPHA & (np.arange(256) < 0x80)


def piece_starts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The byte positions at which pieces start; every text that isn't empty starts one.

    White space outside ASCII before ASCII white space makes one run with it,
    so there is no cut after the bytes that such a character may end in."""
    first = np.zeros(len(raw), bool)
    if len(raw):
        space = SPACE[raw]
        first[1:] = (space[1:] & ~space[:-1]) | (ALPHA[raw[:-1]] & _OTHER[raw[1:]])
        at = np.flatnonzero(first[1:] & (raw[:-1] >= 0x80)) + 1
        two, three = raw[np.maximum(at - 2, 0)], raw[np.maximum(at - 3, 0)]
        wide = (two == 0xC2) | ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & (two >= 0x80) & (two <= 0x81)) | ((three == 0xE3) & (two == 0x80))
        first[at[wide]] = False
        first[off[:-1][off[:-1] < off[1:]]] = True
    return np.flatnonzero(first)


class PieceCoder:
    """Ids of pieces by ``encode``: a list of pieces to a list of their ids, each as bytes of ``dtype``.

    ``folded``: for a tokenizer that lowers case and drops white space; pieces
    are then looked up without the case of A-Z and without the white space they start with."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], dtype: type = np.uint32, folded: bool = False):
        self.encode, self.dtype, self.folded, self.cache = encode, np.dtype(dtype), folded, {}

    def coded(self, pieces: list[bytes]) -> list[bytes]:
        cache = self.cache
        found = [cache.get(p) for p in pieces]
        missing = [k for k, x in enumerate(found) if x is None]
        for k, ids in zip(missing, self.encode([pieces[k] for k in missing]), strict=True):
            found[k] = ids
            if len(cache) < CACHED_PIECES and len(pieces[k]) <= CACHED_BYTES:
                cache[pieces[k]] = ids
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, their offsets by text)."""
        ids, ioff, starts, off = self.by_piece(texts)
        return ids, ioff[np.searchsorted(starts, off)]

    def by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, their offsets by piece, the pieces' first bytes, the texts' offsets)."""
        raw, off = flat(as_strings(texts))
        starts = piece_starts(raw, off)
        borders = np.append(starts, len(raw))
        if self.folded:
            blank = SPACE[raw[starts]]
            kept = np.ones(len(raw), bool)
            kept[starts[blank]] = False
            codes, distinct = named(_LOWER[raw[kept]], borders - np.concatenate([[0], np.cumsum(blank)]))
        else:
            codes, distinct = named(raw, borders)
        found = self.coded(distinct.to_pylist())
        ids = np.frombuffer(b"".join(found), self.dtype)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        ids, ioff = spread(ids, np.concatenate([[0], np.cumsum(lengths)]), codes)
        return ids, ioff, starts, off


def counts_by_text(ioff: np.ndarray, starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    return segment_sum(np.diff(ioff), np.searchsorted(starts, off))
