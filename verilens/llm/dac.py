"""Token ids in directly addressable codes, written to files and read back (operator 4).

A block holds the ids of consecutive documents.  Each id is split into 8-bit
chunks.  Level 0 has the lowest chunk of every id; a level's bitmap says which
of its entries go on, and the next level has only their next chunks.  A rank
directory counts the set bits before each 512 bits of a bitmap, so any single
id is found by one lookup per level (``token_at``), without decoding a block.

Files: Parquet rows, one for each block (shard, block, doc_ids, doc_offsets,
levels, bitmaps, ranks), so they live in any store that Spark writes.  Shards
are ranges of doc_id, blocks follow each other inside a shard; both ascend.
Bounds come from quantiles of doc_id; rows of one very frequent doc_id are
spread over all shards between which it falls.

Defined results: null text is empty (its only id is the end id); a null doc_id
comes first; repeated doc_ids follow each other, ordered by the hash of their
text; starts and sums of an empty table are no rows.  Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from verilens.llm.pieces import PieceCoder
from verilens.llm.textbatch import as_strings, binary, by_slice
from verilens.session import shared_dir

END_ID = 2
#: A block is closed at so many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 19
RANK_BITS = 512
#: Pieces that the library gets as one text, with a special token between them.
JOINED_PIECES = 64

BLOCK = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("doc_offsets", T.ArrayType(T.LongType())),
    T.StructField("levels", T.ArrayType(T.BinaryType())), T.StructField("bitmaps", T.ArrayType(T.BinaryType())),
    T.StructField("ranks", T.ArrayType(T.BinaryType()))])


# -- codes of one block -------------------------------------------------------

def packed(ids: np.ndarray) -> dict[str, list[bytes]]:
    """Levels, continuation bitmaps and rank directories of unsigned ids."""
    rest, levels, bitmaps, ranks = ids.astype(np.uint32), [], [], []
    while True:
        levels.append((rest & np.uint32(0xFF)).astype(np.uint8).tobytes())
        rest >>= np.uint32(8)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        bitmaps.append(bits.tobytes())
        by_block = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        ranks.append(np.concatenate([[0], np.cumsum(by_block)[:-1]]).astype("<u4").tobytes())
        if not more.any():
            return {"levels": levels, "bitmaps": bitmaps, "ranks": ranks}
        rest = rest[more]


def token_at(block: dict[str, list[bytes]], i: int) -> int:
    """Id number i of a block, by one lookup for each of its chunks."""
    out = 0
    for level, (chunks, bitmap, rank) in enumerate(zip(block["levels"], block["bitmaps"], block["ranks"], strict=True)):
        out |= chunks[i] << 8 * level
        if not bitmap[i >> 3] >> (i & 7) & 1:
            break
        first = i // RANK_BITS
        before = int.from_bytes(bitmap[first * RANK_BITS // 8:i // 8 + 1], "little") & ((1 << (i - first * RANK_BITS)) - 1)
        i = int.from_bytes(rank[4 * first:4 * first + 4], "little") + before.bit_count()
    return out


def unpacked(block: dict[str, list[bytes]]) -> np.ndarray:
    """All ids of a block."""
    out = None
    for chunks, bitmap in zip(reversed(block["levels"]), reversed(block["bitmaps"]), strict=True):
        low = np.frombuffer(chunks, np.uint8).astype(np.uint32)
        if out is not None:
            more = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little", count=len(low)).astype(bool)
            low[more] |= out << np.uint32(8)
        out = low
    return out


# -- encoding -----------------------------------------------------------------

class _Library:
    """Ids by the tokenizers library, which sees each distinct piece of a batch once, many in one text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "<u4")
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        # taken out before the text is normalized, with nothing beside it: what is on either side is encoded as if alone
        self.border = next(((i, t.content) for i, t in added.items() if not (t.normalized or t.lstrip or t.rstrip or t.single_word)), None)
        self.coder = PieceCoder(self._encode_pieces, self.dtype, folded=True)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.dtype) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece; none has a special token's string.  A call for each piece costs more than its ids.

        A piece cut out of a longer character never occurs: cuts are at ASCII characters."""
        texts = [p.decode() for p in pieces]
        if not self.border:
            return [x.tobytes() for x in self._ids(texts)]
        border, content = self.border
        runs, width, out = [texts[k:k + JOINED_PIECES] for k in range(0, len(texts), JOINED_PIECES)], self.dtype.itemsize, []
        for run, ids in zip(runs, self._ids([content.join(run) for run in runs]), strict=True):
            ends, raw = np.flatnonzero(ids == border) * width, ids.tobytes()
            if len(ends) == len(run) - 1:
                out += [raw[a:b] for a, b in zip([0, *(ends + width).tolist()], [*ends.tolist(), len(raw)], strict=True)]
            else:  # a border that runs into a piece
                out += [x.tobytes() for x in self._ids(run)]
        return out

    def encode(self, texts: pa.Array, end_id: int) -> pa.Array:
        """Each text's ids and the end id, in a binary value."""
        texts = as_strings(texts)
        special = np.zeros(len(texts), bool)
        for content in self.special:
            special |= pa.compute.match_substring(texts, content).to_numpy(zero_copy_only=False)
        plain = pa.compute.if_else(pa.array(special), "", texts) if special.any() else texts
        ids, off = self.coder.texts(plain)
        lengths = np.diff(off) + 1
        at = np.concatenate([[0], np.cumsum(lengths)])
        out = np.full(at[-1], end_id, self.dtype)
        body = np.ones(len(out), bool)
        body[at[1:] - 1] = False
        out[body] = ids
        coded = binary(out.view(np.uint8), at * self.dtype.itemsize)
        if special.any():  # a special token's string must not be cut
            whole = iter(self._ids(texts.filter(pa.array(special)).to_pylist()))
            end = np.array([end_id], self.dtype).tobytes()
            coded = pa.array([next(whole).tobytes() + end if s else x for s, x in zip(special, coded.to_pylist(), strict=True)], pa.binary())
        return coded


@lru_cache(maxsize=4)
def _library(path: str) -> _Library:
    return _Library(path)


def encoded(text: Column, path: str, end_id: int = END_ID) -> Column:
    """Ids of each text, then the end id: little-endian integers of 2 bytes (4 for a vocabulary beyond 65,536)."""

    @arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        return by_slice(texts, lambda x: _library(path).encode(x, end_id), pa.binary())

    return ids(text)


# -- files --------------------------------------------------------------------

def write(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          shards: int | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents in ascending doc_id order."""
    spark = docs.sparkSession
    n = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = [k / n for k in range(1, n)]
    # at most n - 1 numbers reach the driver
    bounds = (docs.agg(F.percentile_approx(F.col(id_col).cast("long"), cuts, 10_000).alias("b")).first()["b"] if cuts else None) or []
    bounds = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"), encoded(F.col(text_col), path, end_id).alias("ids"))
    low = F.size(F.filter(bounds, lambda b: b < F.col("doc_id")))
    high = F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))
    shard = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(low + F.pmod(F.col("tie"), (high - low + 1).cast("long")).cast("int"))
    rows = rows.withColumn("shard", shard).repartition(n, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "tie")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _library(path).dtype
        shard, number, docs_held, ids_held, held = None, 0, [], [], 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(ids_held)
            off = np.concatenate([[0], np.cumsum([len(x) for x in ids_held])])
            row = {"shard": shard, "block": number, "n_ids": len(ids), "doc_ids": docs_held, "doc_offsets": off.tolist(), **packed(ids)}
            return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

        for batch in batches:
            for k, doc_id, ids in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(ids.as_buffer(), width)
                if docs_held and (k != shard or held + len(ids) > block_ids):
                    yield closed()
                    number = number + 1 if k == shard else 0
                    docs_held, ids_held, held = [], [], 0
                shard = k
                docs_held.append(doc_id)
                ids_held.append(ids)
                held += len(ids)
        if docs_held:
            yield closed()

    rows.select("shard", "doc_id", "ids").mapInArrow(blocks, BLOCK).write.parquet(folder)


_LIST = pa.list_(pa.binary())
_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                     ("doc_offsets", pa.list_(pa.int64())), ("levels", _LIST), ("bitmaps", _LIST), ("ranks", _LIST)])


def read(spark: SparkSession, folder: str, *values: Column) -> DataFrame:
    """One row for each document: doc_id, start (ids of all documents before it),
    n_tokens and ids (little-endian unsigned 32-bit integers).

    ``values``: what to return of ``ids`` instead; it is computed before the
    join with the starts, so that the ids themselves aren't shuffled."""
    blocks = spark.read.schema(BLOCK).parquet(folder)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row for each shard
    before = sizes.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    inside = blocks.select("shard", "block", (F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")).alias("inside"))
    starts = inside.join(before, "shard").select("shard", "block", (F.col("before") + F.col("inside")).alias("first"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                off = np.array(block["doc_offsets"])
                ids = unpacked(block)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block["shard"]] * len(block["doc_ids"]), pa.int32()), pa.array([block["block"]] * len(block["doc_ids"]), pa.int32()),
                    pa.array(block["doc_ids"], pa.int64()), pa.array(off[:-1]), pa.array(np.diff(off)),
                    binary(ids.astype("<u4").view(np.uint8), off * 4)], names=["shard", "block", "doc_id", "at", "n_tokens", "ids"])

    rows = blocks.mapInArrow(documents, "shard int, block int, doc_id long, at long, n_tokens long, ids binary")
    rows = rows.select("shard", "block", "doc_id", "at", "n_tokens", *(values or ["ids"]))
    return rows.join(starts, ["shard", "block"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", *rows.columns[5:])


def new_folder(spark: SparkSession) -> str:
    import uuid
    return f"{shared_dir(spark)}/verilens/ids-{uuid.uuid4().hex}"
