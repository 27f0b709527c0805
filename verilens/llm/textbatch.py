"""Whole texts of an Arrow batch as flat byte arrays.

Spark hands an Arrow UDF a batch of texts; these helpers cut it into slices of
bounded size, find runs of bytes in it without a loop over documents, and
name equal runs by one dictionary code, so that the costly work (hashing,
encoding, scoring) happens once for each distinct run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step handles at once; a longer single text is a step of its own.
SLICE_BYTES = 2 << 20

#: The bytes of ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ALPHA = np.zeros(256, bool)
ALPHA[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
#: Bytes of words: ASCII letters and digits, and every byte of a longer UTF-8 sequence.
WORD = ALPHA | DIGIT | (np.arange(256) >= 0x80)

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x100000001B3


def as_strings(texts: pa.Array) -> pa.Array:
    """Nulls as empty texts, in one contiguous ``string`` array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    return pc.fill_null(texts, "")


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; text i is bytes[offsets[i]:offsets[i + 1]]."""
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def binary(raw: np.ndarray, off: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.Array.from_buffers(kind or pa.binary(), len(off) - 1,
                                 [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    _, off = flat(texts)
    i, n = 0, len(texts)
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1))
        yield texts.slice(i, j - i)
        i = j


def by_slice(texts: pa.Array, work: Callable[[pa.Array], pa.Array], kind: pa.DataType) -> pa.Array:
    """``work`` on each slice of the texts (nulls as empty), as one array of ``kind``."""
    parts = [work(x) for x in slices(as_strings(texts))]
    pa.default_memory_pool().release_unused()
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def segment_sum(values: np.ndarray, off: np.ndarray, dtype=None) -> np.ndarray:
    """Sums of values[off[i]:off[i + 1]]; zero for an empty segment."""
    out = np.zeros((len(off) - 1, *values.shape[1:]), dtype or values.dtype)
    full = off[1:] > off[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, off[:-1][full], axis=0, dtype=out.dtype)
    return out


class Runs:
    """Maximal runs of kept bytes, none of which crosses the end of a text.

    ``kept``: a flag for each byte; ``cuts``: flags of bytes that start a run anyway.
    ``starts``, ``ends``: byte positions; ``off``: runs before each text;
    ``codes``: the dictionary code of each run; ``distinct``: the dictionary."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, kept: np.ndarray, cuts: np.ndarray | None = None):
        first, last = kept.copy(), kept.copy()
        if cuts is None:
            first[1:] &= ~kept[:-1]
            last[:-1] &= ~kept[1:]
        else:
            first[1:] &= ~kept[:-1] | cuts[1:]
            last[:-1] &= ~kept[1:] | cuts[1:]
        edge = off[:-1][off[:-1] < len(raw)]
        first[edge] = kept[edge]
        edge = off[1:][off[1:] > 0] - 1
        last[edge] = kept[edge]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.off = np.searchsorted(self.starts, off)
        where = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        self.codes, self.distinct = named(raw[kept], where)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def named(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes of the pieces raw[off[i]:off[i + 1]], and the distinct pieces."""
    coded = binary(raw, off).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values (uint64, in wrap-around arithmetic)."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX_1
    h = h ^ (h >> np.uint64(27))
    h = h * MIX_2
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), BASE, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def whole_hashes(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece."""
    lengths = np.diff(off)
    if not len(lengths) or not len(raw):
        return mixed(lengths.astype(np.uint64))
    at = np.arange(len(raw)) - np.repeat(off[:-1], lengths)
    return mixed(segment_sum((raw.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[at], off))


def gram_hashes(raw: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-byte windows inside each piece, and their offsets by piece."""
    counts = np.maximum(0, np.diff(off) - n + 1)
    goff = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(goff[-1]) - np.repeat(goff[:-1] - off[:-1], counts)
    p, h = powers(n), np.full(len(at), n, np.uint64)
    for k in range(n):
        h += (raw[at + k].astype(np.uint64) + np.uint64(1)) * p[k] * np.uint64(0x9E3779B97F4A7C15)
    return mixed(h), goff


def spread(values: np.ndarray, off: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces values[off[c]:off[c + 1]] for each c of codes, one after another, and their offsets."""
    lengths = np.diff(off)[codes]
    out = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(out[-1]) + np.repeat(off[codes] - out[:-1], lengths)
    return values[at], out
