"""Alignment of two tokenizers over a corpus, each distinct text once (operator 12).

The table is shuffled by its full text, so that every distinct text is
tokenised and aligned once and carries its multiplicity.  Tokens of A (byte-level
BPE) and B (pieces with byte fallback) are byte ranges of a space and the text;
the offsets where both end cut them into groups, and the two tokens that end at
such an offset are linked.  A block of texts names its distinct id pairs by
number and counts them, weighted by multiplicity, before anything is shuffled.
Corpus-wide counts go back to the blocks as one row for each pair of a block;
the measures of a distinct text are sums over its links, and are joined to the
doc_ids by the SHA-256 of the text, with the copies of a frequent text dealt over salts.

B is encoded piece by piece: no entry of its vocabulary has a space after
something else (checked when it is read), so no merge crosses such a border.

Defined results: texts that are null, empty, or whose tokens don't spell a space
and the text (B's normalisation, U+2581 in the text) have zeros and an empty
digest; special tokens' strings are plain text; repeated rows and repeated
doc_ids each get their text's measures; a null doc_id stays null.  Other columns
are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verilens.llm.bpe import byte_pairs
from verilens.llm.hotkeys import hot_keys, joined
from verilens.llm.textbatch import as_strings, binary, flat, named, slices, spread
from verilens.session import stored

BLANK = "▁"
#: Pieces of B that a worker's cache holds at most, and the longest that it keeps.
CACHED_PIECES, CACHED_BYTES = 100_000, 64


class Pieces:
    """A sentencepiece model that adds a space, piece by piece."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        spelled = [self.model.id_to_piece(i) for i in range(size)]
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in spelled):
            raise ValueError("a piece of the vocabulary crosses the start of a word")
        bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(spelled)]
        self.bytes = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in bytes_of])])
        self.cache: dict[bytes, bytes] = {}

    def _encode(self, piece: bytes) -> bytes:
        text = piece.decode()
        if text.strip(" "):
            ids = self.model.encode(text[1:])  # the model puts the space back
        else:  # blanks alone would lose one, so they follow a word here
            ids = self.model.encode("a" + text)[len(self.model.encode("a")):]
        return np.array(ids, np.int64).tobytes()

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their offsets by text) of texts that each start with a space."""
        first = np.zeros(len(raw), bool)
        blank = raw == 0x20
        first[1:] = blank[1:] & ~blank[:-1]
        first[off[:-1][off[:-1] < off[1:]]] = True
        starts = np.flatnonzero(first)
        codes, distinct = named(raw, np.append(starts, len(raw)))
        cache, found = self.cache, []
        for piece in distinct.to_pylist():
            ids = cache.get(piece)
            if ids is None:
                ids = self._encode(piece)
                if len(cache) < CACHED_PIECES and len(piece) <= CACHED_BYTES:
                    cache[piece] = ids
            found.append(ids)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 8
        ids, ioff = spread(np.frombuffer(b"".join(found), np.int64), np.concatenate([[0], np.cumsum(lengths)]), codes)
        return ids, ioff[np.searchsorted(starts, off)]


class Tokenizer:
    """Ids and byte lengths of texts, as one stream with offsets by text."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, table: np.ndarray, table_off: np.ndarray, raw: np.ndarray, raw_off: np.ndarray):
        self.ids, self.off = ids.astype(np.int64), off
        lengths = np.diff(table_off)[self.ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        spelled, _ = spread(table, table_off, self.ids)
        self.lengths = lengths
        # a text is spelled if it has as many bytes as its tokens, and the same
        same = np.diff(ends[off]) == np.diff(raw_off)
        if len(spelled) == len(raw) and same.all():
            wrong = np.concatenate([[0], np.cumsum(spelled != raw)])
            same &= wrong[raw_off[1:]] == wrong[raw_off[:-1]]
        else:
            for i in np.flatnonzero(same):
                same[i] = np.array_equal(spelled[ends[off[i]]:ends[off[i + 1]]], raw[raw_off[i]:raw_off[i + 1]])
        self.spells = same

    def keep(self, texts: np.ndarray) -> None:
        """Forget the tokens of the other texts."""
        counts = np.where(texts, np.diff(self.off), 0)
        kept = np.repeat(texts, np.diff(self.off))
        self.ids, self.lengths = self.ids[kept], self.lengths[kept]
        self.off = np.concatenate([[0], np.cumsum(counts)])
        self.ends = np.cumsum(self.lengths)


@lru_cache(maxsize=4)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=4)
def _decimals(size: int, marks: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each id in decimal followed by each mark (id * marks + mark), and their offsets."""
    text = [str(i).encode() + marks[k:k + 1] for i in range(size) for k in range(len(marks))]
    return np.frombuffer(b"".join(text), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in text])])


class Aligned:
    """Groups and links of a slice of texts."""

    def __init__(self, texts: pa.Array, path_a: str, path_b: str):
        raw, off = flat(as_strings(texts))
        n = len(off) - 1
        full = np.diff(off) > 0
        # a space before every text that isn't empty
        new_off = off + np.concatenate([[0], np.cumsum(full)])
        spaced = np.full(new_off[-1], 0x20, np.uint8)
        body = np.ones(len(spaced), bool)
        body[new_off[:-1][full]] = False
        spaced[body] = raw
        a_of, b_of = byte_pairs(path_a), _pieces(path_b)
        a = Tokenizer(*a_of.coder.texts(binary(spaced, new_off, pa.string())), a_of.bytes, a_of.offsets, spaced, new_off)
        b = Tokenizer(*b_of.encode(spaced, new_off), b_of.bytes, b_of.offsets, spaced, new_off)
        good = a.spells & b.spells & full
        a.keep(good)
        b.keep(good)
        self.a, self.b = a, b
        # both spell the same bytes, so ends are positions in one stream; every text's end is common
        size = int(a.ends[-1]) + 1 if len(a.ends) else 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[a.ends], at_b[b.ends] = True, True
        last_a, last_b = at_b[a.ends], at_a[b.ends]  # the token is the last of its group
        self.link_a, self.link_b = a.ids[last_a], b.ids[last_b]
        self.link_off = np.concatenate([[0], np.cumsum(last_a)])[a.off]
        self.n_a, self.n_b, self.n_groups = np.diff(a.off), np.diff(b.off), np.diff(self.link_off)
        self.digests = self._digests(last_a, last_b, a_of, b_of)
        self.n = n

    def _digests(self, last_a: np.ndarray, last_b: np.ndarray, a_of, b_of) -> list[str]:
        a, b = self.a, self.b
        group_a = np.cumsum(last_a) - last_a  # groups that end before the token's
        group_b = np.cumsum(last_b) - last_b
        size_a, size_b = np.bincount(group_a, minlength=len(self.link_a)), np.bincount(group_b, minlength=len(self.link_a))
        before_a, before_b = np.cumsum(size_a), np.cumsum(size_b) - size_b
        place_a = np.arange(len(a.ids)) + before_b[group_a] if len(a.ids) else np.zeros(0, np.int64)
        place_b = np.arange(len(b.ids)) + before_a[group_b] if len(b.ids) else np.zeros(0, np.int64)
        raw_a, off_a = _decimals(len(a_of.offsets) - 1, b",|")
        raw_b, off_b = _decimals(len(b_of.offsets) - 1, b",;")
        codes = np.empty(len(a.ids) + len(b.ids), np.int64)
        codes[place_a] = a.ids * 2 + last_a
        codes[place_b] = 2 * (len(a_of.offsets) - 1) + b.ids * 2 + last_b
        table, table_off = np.concatenate([raw_a, raw_b]), np.concatenate([off_a, off_a[-1] + off_b[1:]])
        text, text_off = spread(table, table_off, codes)
        bounds = text_off[a.off + b.off]
        view = memoryview(np.ascontiguousarray(text))
        # the last group has no mark behind it
        return [hashlib.sha256(view[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


BLOCK = T.StructType([
    T.StructField("block", T.BinaryType()), T.StructField("digests", T.ArrayType(T.BinaryType())), T.StructField("copies", T.ArrayType(T.LongType())),
    *(T.StructField(x, T.ArrayType(T.LongType())) for x in ("n_a", "n_b", "n_groups")), T.StructField("groups", T.ArrayType(T.StringType())),
    T.StructField("links", T.BinaryType()), T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("weights", T.ArrayType(T.LongType()))])
_BLOCK = pa.schema([("block", pa.binary()), ("digests", pa.list_(pa.binary())), ("copies", pa.list_(pa.int64())), *((x, pa.list_(pa.int64())) for x in ("n_a", "n_b", "n_groups")),
                    ("groups", pa.list_(pa.string())), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64()))])


def _blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """One row for each slice of distinct texts: their counts, and each link's number in the list of the block's id pairs."""
    for batch in batches:
        at = 0
        for part in slices(batch.column("text")):
            n = len(part)
            digests, copies = (batch.column(c).slice(at, n) for c in ("digest", "copies"))
            at += n
            x = Aligned(part, path_a, path_b)
            pairs, number = np.unique(x.link_a << 32 | x.link_b, return_inverse=True)
            times = np.repeat(copies.to_numpy(), x.n_groups)
            weights = np.bincount(number, weights=times, minlength=len(pairs)).astype(np.int64) if times.sum() < 1 << 52 else _exact_sums(number, times, len(pairs))
            row = {"block": digests[0].as_py(), "digests": digests.to_pylist(), "copies": copies.to_pylist(),
                   "n_a": x.n_a.tolist(), "n_b": x.n_b.tolist(), "n_groups": x.n_groups.tolist(), "groups": x.digests,
                   "links": number.astype("<u4" if len(pairs) > 1 << 16 else "<u2").tobytes(), "pairs": pairs.tolist(), "weights": weights.tolist()}
            yield pa.RecordBatch.from_pylist([row], schema=_BLOCK)
            pa.default_memory_pool().release_unused()


def _exact_sums(number: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, number, times)
    return out


MEASURES = "digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, copies long"


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            values = {c: row.column(c)[0].values for c in ("digests", "copies", "n_a", "n_b", "n_groups", "groups")}
            n_groups = values["n_groups"].to_numpy()
            off = np.concatenate([[0], np.cumsum(n_groups)])
            known = row.column("known")[0].values
            size = len(known)
            at = known.field("number").to_numpy()
            count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
            count[at], best[at] = known.field("n").to_numpy(), known.field("best").to_numpy(zero_copy_only=False)
            links = np.frombuffer(row.column("links")[0].as_buffer(), "<u4" if size > 1 << 16 else "<u2")
            sums = [np.concatenate([[0], np.cumsum(v[links])]) for v in (best, count)]
            n_best, count_sum = (s[off[1:]] - s[off[:-1]] for s in sums)
            yield pa.RecordBatch.from_arrays([values["digests"], values["n_a"], values["n_b"], values["n_groups"], pa.array(n_groups), pa.array(n_best), pa.array(count_sum),
                                              values["groups"], values["copies"]],
                                             names=["digest", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "copies"])


def alignments(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(measures, pairs): one row for each distinct text that isn't empty (digest, its
    measures, copies), and one for each id pair (pair, n, best)."""
    texts = docs.select(F.col(text_col).alias("text")).where(F.col("text") != "").groupBy("text").agg(F.count("*").alias("copies"))
    texts = texts.select("text", F.unhex(F.sha2("text", 256)).alias("digest"), "copies")
    blocks = stored(texts.mapInArrow(lambda b: _blocks(b, path_a, path_b), BLOCK), "aligned")
    of_block = F.explode(F.arrays_zip("pairs", "weights")).alias("x")
    pairs = blocks.select(of_block).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.weights").alias("n"))
    pairs = pairs.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    pairs = stored(pairs.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "id-pairs")
    # a block has a pair once, so no pair is in more rows than there are blocks
    asked = blocks.select("block", F.posexplode("pairs").alias("number", "pair"))
    known = asked.join(pairs, "pair").groupBy("block").agg(F.collect_list(F.struct("number", "n", "best")).alias("known"))
    nothing = F.array().cast("array<struct<number:int,n:long,best:boolean>>")
    measured = blocks.drop("pairs", "weights").join(known, "block", "left").withColumn("known", F.coalesce("known", nothing))
    return measured.mapInArrow(_measures, MEASURES), pairs


VALUES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id and the measures of its text."""
    measures = stored(alignments(docs, path_a, path_b, text_col)[0], "measures")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    full = own.where(F.col("text") != "").select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    found = joined(full, measures.drop("copies"), ["digest"], hot_keys(measures, ["digest"], "copies"), ["doc_id"])
    zero = [F.lit("" if v == "groups_sha256" else 0).cast("string" if v == "groups_sha256" else "long").alias(v) for v in VALUES]
    return found.select("doc_id", *VALUES).unionByName(own.where(F.coalesce(F.col("text") == "", F.lit(True))).select("doc_id", *zero))
