"""Byte-level BPE by a backtracking encoder, and an offset-table decoder (operator 9).

Encoder: an Aho-Corasick automaton over the vocabulary gives the longest token
that starts at each byte of a pre-token.  The encoder takes it if it may stand
after the previous token, else the next shorter prefix that is a token, else it
takes the previous token back; an end that was given up is marked and never
tried again, so the work is linear in the length.  Two tokens may stand side by
side if the merges of their joined bytes would leave exactly those two; that is
read off their merge histories (no re-encoding) and kept in a table.

Decoder: the bytes of all tokens lie in one array; an offset table turns the
ids of a batch into one gather.

Defined results: null is the empty text, which has no ids and decodes to an
empty text; repeated rows are encoded alike; a special token's string in a text
is its one id, as the library does; an empty table gives no rows.  The Column
functions read one column, so other columns and their names don't matter.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from verilens.llm.pieces import PieceCoder
from verilens.llm.textbatch import as_strings, binary, by_slice, flat, segment_sum, spread

#: The pre-token pattern of byte-level BPE files, with white space spelled out.
_S = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKENS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Pairs that the compatibility table holds before it starts anew.
TABLE_PAIRS = 200_000
_NEVER = 1 << 60


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class BytePairs:
    """A byte-level BPE vocabulary read from a tokenizer file in JSON."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_symbols()
        vocab = spec["model"]["vocab"]
        pieces = {i: bytes(symbol[c] for c in s) for s, i in vocab.items()}
        size = 1 + max([*pieces, *(t["id"] for t in spec["added_tokens"])])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.id_of = {b: i for i, b in pieces.items()}
        self.rank = [-1] * size  # when a token's merge is made; single bytes come first
        self.left, self.right = [0] * size, [0] * size
        self.pair: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            i, a, b = vocab[a + b], vocab[a], vocab[b]
            self.rank[i], self.left[i], self.right[i] = rank, a, b
            self.pair[a, b] = i
        self.fits: dict[int, bool] = {}
        usable = {i: b for i, b in pieces.items() if len(b) == 1 or self.rank[i] >= 0 and self._side_by_side(self.left[i], self.right[i], self.rank[i])}
        self.whole = {b: i for i, b in usable.items()}
        self.length = [len(pieces.get(i, b"")) for i in range(size)]
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        self.automaton = ahocorasick.Automaton()
        for i, b in usable.items():
            self.automaton.add_word(b.decode("latin-1"), i)
            self.shorter[i] = next((self.whole[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.whole), -1)
        self.automaton.make_automaton()
        text = [pieces.get(i, b"") for i in range(size)]
        for content, i in self.special.items():
            text[i] = content.encode()
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in text])])
        self.coder = PieceCoder(self._encode_pieces)

    def _side_by_side(self, a: int, b: int, before: int = _NEVER) -> bool:
        """Whether no merge crosses the border of a and b earlier than ``before``.

        Walks both histories back in time: the token made last is taken apart.
        Of equal merges the left one is made first."""
        rank, pair = self.rank, self.pair
        until_a = until_b = before
        while True:
            made = pair.get((a, b))
            if made is not None and rank[made] < until_a and rank[made] <= until_b:
                return False
            if rank[a] > rank[b]:
                until_a, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                until_b, b = rank[b], self.left[b]
            else:
                return True

    def encode_pre_token(self, text: bytes) -> list[int]:
        if (i := self.whole.get(text)) is not None:
            return [i]
        longest = [-1] * len(text)
        for end, i in self.automaton.iter(text.decode("latin-1")):
            longest[end - self.length[i] + 1] = i  # later ends are longer
        fits, length, shorter = self.fits, self.length, self.shorter
        n, at, found = len(text), 0, []
        open_end = [True] * (n + 1)
        token = longest[0]
        while True:
            last = found[-1] if found else -1
            while token >= 0:
                end = at + length[token]
                if open_end[end]:
                    if last < 0:
                        break
                    key = last << 32 | token
                    ok = fits.get(key)
                    if ok is None:
                        if len(fits) >= TABLE_PAIRS:
                            fits.clear()
                        ok = fits[key] = self._side_by_side(last, token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                at += length[token]
                if at == n:
                    return found
                token = longest[at]
            else:  # nothing fits here: give this end up and shorten the token before
                if last < 0:
                    raise ValueError("the vocabulary lacks a byte")
                open_end[at] = False
                found.pop()
                at -= length[last]
                token = last

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out = []
        for p in pieces:
            if p.isalpha() or p[:1] == b" " and p[1:].isalpha():
                ids = self.encode_pre_token(p)
            else:
                ids = list(chain.from_iterable(self.encode_pre_token(t.encode()) for t in PRE_TOKENS.findall(p.decode())))
            out.append(array("I", ids).tobytes())
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text) of a string array; nulls count as empty."""
        texts = as_strings(texts)
        with_special = np.zeros(len(texts), bool)
        for content in self.special:
            with_special |= pa.compute.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not with_special.any():
            return self.coder.texts(texts)
        # the stretches between special tokens are texts of their own
        parts, ends = [], []
        for text in texts.to_pylist():
            at = 0
            for m in self.special_pattern.finditer(text):
                parts += [(text[at:m.start()], -1), ("", self.special[m[0]])]
                at = m.end()
            parts.append((text[at:], -1))
            ends.append(len(parts))
        ids, off = self.coder.texts(pa.array([p for p, _ in parts], pa.string()))
        own = np.array([i for _, i in parts])
        lengths = np.diff(off) + (own >= 0)
        at = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(at[-1], np.uint32)
        single = np.repeat(own >= 0, lengths)
        out[single] = own[own >= 0]
        out[~single] = ids
        return out, at[np.concatenate([[0], ends])]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> pa.Array:
        """The text of each run ids[off[i]:off[i + 1]]; unknown ids are left out,
        bytes that are no UTF-8 become replacement characters."""
        known = ids < len(self.offsets) - 1
        if not known.all():
            off = np.concatenate([[0], np.cumsum(segment_sum(known.astype(np.int64), off))])
            ids = ids[known]
        raw, boff = spread(self.bytes, self.offsets, ids)
        out = binary(raw, boff[off], pa.string())
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:
            out = pa.array([x.decode("utf-8", "replace") for x in binary(raw, boff[off]).to_pylist()], pa.string())
        return out


@lru_cache(maxsize=4)
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(path)


def encode(text: Column, path: str) -> Column:
    """The ids of each text, as little-endian unsigned 32-bit integers in a binary value."""

    @arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        return by_slice(texts, lambda x: _packed(*byte_pairs(path).encode(x)), pa.binary())

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of such a binary value; null decodes to an empty text."""

    @arrow_udf("string")
    def texts(packed: pa.Array) -> pa.Array:
        return by_slice_of_ids(packed, path)

    return texts(ids)


def by_slice_of_ids(packed: pa.Array, path: str) -> pa.Array:
    raw, off = flat(pa.compute.fill_null(packed, b""))
    return byte_pairs(path).decode(raw[:off[-1] // 4 * 4].view("<u4"), off // 4)


def round_trip(text: Column, path: str) -> Column:
    """struct(ids, decoded): the ids of each text and the text that they decode to."""
    kind = pa.struct([("ids", pa.binary()), ("decoded", pa.string())])

    def both(texts: pa.Array) -> pa.Array:
        ids = _packed(*byte_pairs(path).encode(texts))
        return pa.StructArray.from_arrays([ids, by_slice_of_ids(ids, path)], fields=list(kind))

    @arrow_udf("ids binary, decoded string")
    def coded(texts: pa.Array) -> pa.Array:
        return by_slice(texts, both, kind)

    return coded(text)


def _packed(ids: np.ndarray, off: np.ndarray) -> pa.Array:
    return binary(ids.astype("<u4").view(np.uint8), off * 4)
