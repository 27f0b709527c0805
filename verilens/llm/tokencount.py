"""Token counts that follow edits (operator 8).

The pieces of a text (see ``pieces``) are the leaves' contents: a leaf holds up
to ``LEAF_PIECES`` of them, and a segment tree over the leaves keeps the sums of
their tokens and of their bytes.  An edit re-encodes only the leaves it touches
and one unchanged leaf on either side, whose outer borders stay borders of
pieces; the new counts go into the same leaves and up the tree.

Defined results: null text is an empty document (a tree with one empty leaf);
edits are (start, length, replacement) in bytes of the UTF-8 text, ascending and
without overlap, and keep characters whole; a null or empty list changes
nothing; a null replacement deletes.  Repeated rows are counted alike, other
columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from verilens.llm.pieces import PieceCoder
from verilens.llm.textbatch import DIGIT, SLICE_BYTES, as_strings, flat, segment_sum, slices

LEAF_PIECES = 16
#: Digits in a run that ``long_numbers`` blanks.
LONG_NUMBER = 4


class _Counter:
    """Counts of tokens by a file of merge ranks."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.coder = PieceCoder(self._counts, np.uint32)

    def _counts(self, pieces: list[bytes]) -> list[bytes]:
        """One number for each piece: its tokens."""
        count = self.encoding.encode_ordinary
        return [len(count(p.decode())).to_bytes(4, "little") for p in pieces]

    def by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts, _, starts, off = self.coder.by_piece(texts)
        return counts, starts, off


@lru_cache(maxsize=4)
def _counter(path: str) -> _Counter:
    return _Counter(path)


class SegmentTree:
    """Sums over leaves: node 1 is the root, node k has the children 2 k and 2 k + 1."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        self.size = 1 << max(0, len(tokens) - 1).bit_length()
        self.nodes = np.zeros((2 * self.size, 2), np.int64)
        self.nodes[self.size:self.size + len(tokens), 0] = tokens
        self.nodes[self.size:self.size + len(tokens), 1] = lengths
        level = self.size
        while level > 1:
            self.nodes[level // 2:level] = self.nodes[level:2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2
        self.leaves = max(1, len(tokens))

    @property
    def total(self) -> int:
        return int(self.nodes[1, 0])

    def put(self, leaf: int, tokens: int, length: int) -> None:
        k = self.size + leaf
        by = np.array([tokens, length]) - self.nodes[k]
        while k:
            self.nodes[k] += by
            k //= 2

    def leaf_at(self, byte: int) -> int:
        """The leaf that holds a byte (the last one with bytes, for the end of the text)."""
        k, byte = 1, min(byte, max(0, int(self.nodes[1, 1]) - 1))
        while k < self.size:
            k *= 2
            if byte >= self.nodes[k, 1]:
                byte -= self.nodes[k, 1]
                k += 1
        return min(k - self.size, self.leaves - 1)

    def start(self, leaf: int) -> int:
        """Bytes before a leaf."""
        k, before = self.size + leaf, 0
        while k > 1:
            if k & 1:
                before += int(self.nodes[k - 1, 1])
            k //= 2
        return before


def trees(texts: pa.Array, path: str) -> list[SegmentTree]:
    counts, starts, off = _counter(path).by_piece(texts)
    first = np.searchsorted(starts, off)
    lengths = np.diff(np.append(starts, off[-1]))
    leaves = -(-np.diff(first) // LEAF_PIECES)
    loff = np.concatenate([[0], np.cumsum(leaves)])
    # the first piece of every leaf
    cut = (np.arange(loff[-1]) - np.repeat(loff[:-1], leaves)) * LEAF_PIECES + np.repeat(first[:-1], leaves)
    bounds = np.append(cut, len(starts))
    tokens, size = segment_sum(counts.astype(np.int64), bounds), segment_sum(lengths, bounds)
    return [SegmentTree(tokens[a:b], size[a:b]) for a, b in zip(loff[:-1], loff[1:], strict=True)]


def edited(text: bytes, tree: SegmentTree, edits: list[dict], path: str) -> tuple[bytes, int]:
    """The text after the edits, and the bytes that were encoded again; the tree is brought up to date.

    Regions follow each other: ``done`` is what lies before the last one, ``held`` the
    last region as it is now, ``at`` its place in the new text; the text from ``rest`` on is untouched.
    Where a region lost most of its pieces, the next one may start before it."""
    again, shift, text = 0, 0, memoryview(text)  # its slices are no copies
    done, held, at, rest = [], b"", 0, 0
    k = 0
    while k < len(edits):
        start = edits[k]["start"] + shift
        lo = max(0, tree.leaf_at(start) - 1)
        hi = min(tree.leaves - 1, tree.leaf_at(start + max(0, edits[k]["length"] - 1)) + 1)
        left = tree.start(lo)
        right = tree.start(hi) + int(tree.nodes[tree.size + hi, 1])
        while left < at:
            part = memoryview(done.pop())
            kept = max(0, len(part) - (at - left))
            held, at = b"".join([part[kept:], held]), at - len(part) + kept
            if kept:
                done.append(part[:kept])
        between = max(0, left - at - len(held))
        done += [held[:left - at], text[rest:rest + between]]
        held, at, rest = held[left - at:], left, rest + between
        missing = max(0, right - left - len(held))
        region, rest, old_shift = b"".join([held, text[rest:rest + missing]]), rest + missing, shift
        # every edit that ends inside this region, with a leaf to spare, is made at once
        inner = tree.start(hi) if hi < tree.leaves - 1 else right + 1
        pieces, copied = [], 0
        while k < len(edits) and (where := edits[k]["start"] + old_shift) < inner and where + edits[k]["length"] <= (inner if inner <= right else right):
            put, a = (edits[k]["replacement"] or "").encode(), where - left
            pieces += [region[copied:a], put]
            copied = a + edits[k]["length"]
            shift += len(put) - edits[k]["length"]
            k += 1
        held = b"".join([*pieces, region[copied:]])
        again += len(held)
        counts, starts, off = _counter(path).by_piece(pa.array([held.decode()], pa.string()))
        lengths = np.diff(np.append(starts, off[-1]))
        for n, leaf in enumerate(range(lo, hi + 1)):
            a = n * LEAF_PIECES
            b = a + LEAF_PIECES if leaf < hi else len(counts)  # the last leaf takes the rest
            tree.put(leaf, int(counts[a:b].sum()), int(lengths[a:b].sum()))
    return b"".join([*done, held, text[rest:]]), again


_EDITS = "array<struct<start:int,length:int,replacement:string>>"


def segment_trees(text: Column, path: str) -> Column:
    """struct(n_tokens, tree) of each text; ``tree`` has the tokens and bytes of its leaves, to be kept and edited later."""
    kind = pa.struct([("n_tokens", pa.int64()), ("tree", pa.list_(pa.int64()))])

    def built(part: pa.Array) -> pa.Array:
        rows = trees(part, path)
        return pa.array([{"n_tokens": t.total, "tree": t.nodes[t.size:t.size + t.leaves].ravel().tolist()} for t in rows], kind)

    @arrow_udf("n_tokens long, tree array<long>")
    def trees_of(texts: pa.Array) -> pa.Array:
        parts = [built(part) for part in slices(as_strings(texts), SLICE_BYTES)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return trees_of(text)


def recounted(text: Column, tree: Column, edits: Column, path: str) -> Column:
    """struct(n_tokens_after, tree_after, text_after, bytes_again) of each text whose kept tree takes its edits (null: none).

    Only the regions that edits touch are encoded; a null tree is that of an empty text."""
    kind = pa.struct([("n_tokens_after", pa.int64()), ("tree_after", pa.list_(pa.int64())), ("text_after", pa.string()), ("bytes_again", pa.int64())])

    def one(value: pa.Scalar, kept: list | None, todo: list | None) -> dict:
        sums = np.array(kept or [], np.int64).reshape(-1, 2)
        tree = SegmentTree(sums[:, 0], sums[:, 1])
        if not todo:
            return {"n_tokens_after": tree.total, "tree_after": kept, "text_after": value.as_py(), "bytes_again": 0}
        after, again = edited(value.as_buffer().to_pybytes(), tree, todo, path)
        return {"n_tokens_after": tree.total, "tree_after": tree.nodes[tree.size:tree.size + tree.leaves].ravel().tolist(), "text_after": after.decode(), "bytes_again": again}

    @arrow_udf("n_tokens_after long, tree_after array<long>, text_after string, bytes_again long")
    def counts(texts: pa.Array, kept: pa.Array, todo: pa.Array) -> pa.Array:
        return pa.array([one(v, t, e) for v, t, e in zip(as_strings(texts), kept.to_pylist(), todo.to_pylist(), strict=True)], kind)

    return counts(text, tree, edits.cast(_EDITS))


def counted(text: Column, path: str, edits: Column | None = None) -> Column:
    """struct(n_tokens, tree, n_tokens_after, text_after, bytes_again): ``segment_trees`` and ``recounted`` of each text in one pass."""
    kind = pa.struct([("n_tokens", pa.int64()), ("tree", pa.list_(pa.int32())), ("n_tokens_after", pa.int64()),
                      ("text_after", pa.string()), ("bytes_again", pa.int64())])

    def both(texts: pa.Array, lists: list) -> pa.Array:
        rows = []
        for value, tree, todo in zip(texts, trees(texts, path), lists, strict=True):
            total, nodes = tree.total, tree.nodes[1:, 0].astype(np.int32)
            after, again = edited(value.as_buffer().to_pybytes(), tree, todo, path) if todo else (None, 0)
            rows.append((total, nodes, tree.total, value.as_py() if after is None else after.decode(), again))
        n, nodes, n_after, after, again = zip(*rows, strict=True)
        loff = np.concatenate([[0], np.cumsum([len(x) for x in nodes])])
        return pa.StructArray.from_arrays([
            pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(loff, pa.int32()), pa.array(np.concatenate(nodes), pa.int32())),
            pa.array(n_after, pa.int64()), pa.array(after, pa.string()), pa.array(again, pa.int64())], fields=list(kind))

    @arrow_udf("n_tokens long, tree array<int>, n_tokens_after long, text_after string, bytes_again long")
    def counts(texts: pa.Array, todo: pa.Array) -> pa.Array:
        out, at = [], 0
        for part in slices(as_strings(texts), SLICE_BYTES):
            out.append(both(part, todo.slice(at, len(part)).to_pylist()))
            at += len(part)
        return pa.concat_arrays(out) if out else pa.array([], kind)

    from pyspark.sql import functions as F
    return counts(text, F.lit(None).cast(_EDITS) if edits is None else edits.cast(_EDITS))


def long_numbers(text: Column, digits: int = LONG_NUMBER, replacement: str = "#") -> Column:
    """Edits that replace every run of at least ``digits`` ASCII digits."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("replacement", pa.string())]))
    run = re.compile(rb"[0-9]{%d,}" % digits)

    @arrow_udf("array<struct<start:int,length:int,replacement:string>>")
    def edits(texts: pa.Array) -> pa.Array:
        texts = as_strings(texts)
        raw, off = flat(texts)
        some = segment_sum(DIGIT[raw].astype(np.int64), off) >= digits
        return pa.array([[{"start": m.start(), "length": m.end() - m.start(), "replacement": replacement}
                          for m in run.finditer(texts[i].as_buffer().to_pybytes())] if some[i] else None for i in range(len(texts))], kind)

    return edits(text)
