"""Removal of word windows that occur more than once in a corpus (operator 13).

Where equal windows meet: the least hash of the runs of 8 words inside a window
of 35 (its minimizer, the leftmost of equals) is the same wherever the window
stands.  Neighbouring windows that share it are one stretch, of 62 words at
most, and each window occurrence is in exactly one stretch.  Stretches are dealt
by their minimizer; a shard is a set of whole minimizers.

1. Stretches are counted by minimizer, with a 64-bit digest of their words.  A
   minimizer that occurs once has no repeated window.  If all its stretches are
   equal, all their windows are repeated.
2. The words of the others' distinct stretches go to their shards, chosen by a Bloom
   filter of bounded size (a false positive costs a row, not a result).  A
   shard's compressed FM-index (``fmindex``) has all of them; each that
   occurs once is streamed through it by backward search, and the matches of two
   occurrences and 35 words or more give its repeated windows.
3. A minimizer with more than ``MOST_STRETCHES`` distinct stretches (the border of a
   passage that very many documents share) would be one large shard.  Its
   windows are counted one by one by a 128-bit hash instead.
4. The masks of repeated windows go back to the documents' stretches, those of
   very frequent stretches over salts, and each document loses its covered words.

Words of a shard are compared as such; minimizers, digests and counts rest on
64-bit hashes of words and stretches.

Defined results: null and empty texts have no words and the hash of the empty
string; texts of fewer than 35 words lose nothing; repeated rows count as
documents of their own, so both copies lose their words; a null doc_id stays
null.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verilens.llm.fmindex import repeated_windows
from verilens.llm.grouped import changes, whole_groups
from verilens.llm.hotkeys import hot_keys, joined
from verilens.llm.templates import document_key
from verilens.llm.textbatch import SPACE, Runs, as_strings, flat, mixed, segment_sum, slices, spread, whole_hashes
from verilens.session import stored

WINDOW, GRAM = 35, 8
#: Distinct stretches of one minimizer that go to one shard at most, and words at which a shard's index is built.
MOST_STRETCHES, SHARD_WORDS = 2048, 1 << 17
#: Bits of a Bloom filter at most; it is sent to every task.
MOST_BITS = 1 << 27
#: Parts in which a filter is built.
FILTER_PARTS = 64

_P = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 30) - 1)  # a text has fewer than 2 ** 30 words


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


class Stretches:
    """The stretches of a slice of texts."""

    def __init__(self, texts: pa.Array, length: int = WINDOW, gram: int = GRAM):
        raw, off = flat(texts)
        self.runs = runs = Runs(raw, off, ~SPACE[raw])
        n, span = len(runs.codes), length - gram + 1
        h = whole_hashes(*flat(runs.distinct))[runs.codes] if n else np.zeros(0, np.uint64)
        self.hashes, self.length = h, length
        if n < length:
            self.start = self.windows = self.doc = np.zeros(0, np.int64)
            self.minimizer = self.digest = np.zeros(0, np.int64)
            return
        grams = np.zeros(n - gram + 1, np.uint64)
        for k in range(gram):
            grams = grams * _P + h[k:k + len(grams)]
        grams = mixed(grams)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        have = 1
        while 2 * have <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        least = np.minimum(least[:len(least) - (span - have)], least[span - have:])
        end = np.repeat(runs.off[1:], np.diff(runs.off))[:len(least)]
        whole = np.arange(len(least)) + length <= end
        place = np.where(whole, (least & _PLACE).astype(np.int64), -1)
        new = whole.copy()
        new[1:] &= place[1:] != place[:-1]
        stop = whole.copy()
        stop[:-1] &= place[1:] != place[:-1]
        at = np.flatnonzero(new)
        self.start, self.windows = at, np.flatnonzero(stop) - at + 1
        self.minimizer = grams[place[at]].view(np.int64)
        self.digest = self.hash_of(at, self.windows + length - 1, 1)
        self.doc = np.searchsorted(runs.off, at, side="right") - 1

    def hash_of(self, start: np.ndarray, words: np.ndarray, seed: int) -> np.ndarray:
        """A 64-bit hash of each run of words; ``seed`` chooses the polynomial's base."""
        base = int(_P) ^ (seed << 32)
        power = np.full(len(self.hashes) + 1, base, np.uint64)
        power[0] = 1
        back = np.full(len(self.hashes) + 1, _inverse(base), np.uint64)
        back[0] = 1
        power, back = np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.hashes + np.uint64(seed)) * power[:-1], dtype=np.uint64)])
        return mixed((sums[start + words] - sums[start]) * back[start] + words.astype(np.uint64)).view(np.int64)

    def words(self, start: np.ndarray, words: np.ndarray) -> list[bytes]:
        """The words of each run, each with a space behind it."""
        table, table_off = spaced(self.runs.distinct)
        bounds = np.concatenate([[0], np.cumsum(words)])
        every = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], words)
        out, out_off = spread(table, table_off, self.runs.codes[every])
        out, cuts = out.tobytes(), out_off[bounds].tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def spaced(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the words, each with a space behind it, and their offsets."""
    raw, off = flat(words)
    new = off + np.arange(len(off))
    out = np.full(new[-1], 0x20, np.uint8)
    body = np.ones(len(out), bool)
    body[new[1:] - 1] = False
    out[body] = raw
    return out, new


# -- filters ------------------------------------------------------------------

def _filter_of(keys: DataFrame, key: str, n: int) -> np.ndarray:
    """A Bloom filter (packed bits, two places for a key) of ``n`` longs, at most MOST_BITS bits.

    Each part of it is made by one task; the driver puts FILTER_PARTS parts together."""
    size = min(MOST_BITS, max(1 << 16, 1 << (12 * max(1, n) - 1).bit_length()))
    part_bits = size // FILTER_PARTS
    places = F.explode(F.array(*[F.shiftrightunsigned(F.col(key), s).bitwiseAND(F.lit(size - 1)) for s in (0, 32)]))
    places = keys.select(places.alias("place")).select(F.expr(f"place div {part_bits}").cast("int").alias("part"), (F.col("place") % part_bits).cast("int").alias("place")).distinct()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            part, place = batch.column("part").to_numpy(), batch.column("place").to_numpy()
            for k in np.unique(part).tolist():
                parts.setdefault(k, np.zeros(part_bits, bool))[place[part == k]] = True
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([np.packbits(b, bitorder="little").tobytes() for b in parts.values()], pa.binary())],
                                             names=["part", "bits"])

    bits = np.zeros(size // 8, np.uint8)
    for r in places.repartition(FILTER_PARTS, "part").mapInArrow(made, "part int, bits binary").collect():  # FILTER_PARTS rows
        at = r["part"] * part_bits // 8
        bits[at:at + part_bits // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    h, mask = keys.view(np.uint64), np.uint64(len(bits) * 8 - 1)
    hit = np.ones(len(h), bool)
    for shift in (0, 32):
        place = (h >> np.uint64(shift)) & mask
        hit &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return hit


# -- rows ---------------------------------------------------------------------

def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, Stretches]]:
    """(rows before, stretches) of each slice of a batch's texts."""
    at = 0
    for part in slices(as_strings(batch.column("text"))):
        yield at, Stretches(part)
        at += len(part)


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, number of rows) of each distinct key."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, x in _parts(batch):
            at, n = _distinct(x.minimizer, x.digest)
            yield pa.RecordBatch.from_arrays([pa.array(x.minimizer[at]), pa.array(x.digest[at]), pa.array(n)], names=["m", "d", "n"])


def _worded(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The words of stretches whose minimizer is in the filter."""
    for batch in batches:
        for _, x in _parts(batch):
            hit = np.flatnonzero(_may_hold(bits, x.minimizer))
            at, n = _distinct(x.minimizer[hit], x.digest[hit])
            at = hit[at]
            yield pa.RecordBatch.from_arrays([pa.array(x.minimizer[at]), pa.array(x.digest[at]), pa.array(n),
                                              pa.array(x.words(x.start[at], x.windows[at] + x.length - 1), pa.binary())], names=["m", "d", "n", "words"])


def _placed(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Where the stretches stand whose minimizer is in the filter."""
    for batch in batches:
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        for before, x in _parts(batch):
            at = np.flatnonzero(_may_hold(bits, x.minimizer))
            doc = x.doc[at]
            yield pa.RecordBatch.from_arrays([pa.array(x.minimizer[at]), pa.array(x.digest[at]), pa.array(k1[before + doc]), pa.array(k2[before + doc]),
                                              pa.array((x.start[at] - x.runs.off[doc]).astype(np.int32)), pa.array(x.windows[at].astype(np.int32))],
                                             names=["m", "d", "k1", "k2", "start", "windows"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct stretches of whole minimizers: the masks of their repeated windows."""
    held: list[pa.Table] = []
    words = 0

    def shard() -> pa.RecordBatch:
        table = pa.concat_tables(held).combine_chunks()
        raw, off = flat(table.column("words").chunk(0).cast(pa.binary()) if table.num_rows else pa.array([], pa.binary()))
        runs = Runs(raw, off, raw != 0x20)
        codes = runs.codes + 1
        size = np.diff(runs.off)
        starts = runs.off[:-1] + np.arange(len(size))
        text = np.zeros(len(codes) + len(size), np.int64)
        body = np.ones(len(text), bool)
        body[starts + size] = False
        text[body] = codes
        found = repeated_windows(text, starts, size - WINDOW + 1, table.column("n").to_numpy() >= 2, WINDOW)
        keep = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays([pa.array(table.column(c).to_numpy()[keep]) for c in ("m", "d", "n")] + [pa.array(found[keep])], names=["m", "d", "n", "mask"])

    for table in whole_groups(batches, ["m"]):
        ends = np.append(changes(table, ["m"]), table.num_rows)
        at, size = 0, table.column("size").to_numpy()
        for end in ends.tolist():
            held.append(table.slice(at, end - at))
            words += int(size[at:end].sum())
            at = end
            if words >= SHARD_WORDS:
                yield shard()
                held, words = [], 0
    if held:
        yield shard()


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the stretches, by a hash of 128 bits."""
    for batch in batches:
        at = 0
        for part in slices(as_strings(batch.column("words").cast(pa.string()))):
            x = Stretches(part)
            windows = np.maximum(np.diff(x.runs.off) - WINDOW + 1, 0)
            bounds = np.concatenate([[0], np.cumsum(windows)])
            which = np.repeat(np.arange(len(part)), windows)
            number = np.arange(bounds[-1]) - bounds[:-1][which]
            start, size = x.runs.off[which] + number, np.full(len(which), WINDOW)
            m, d, n = (batch.column(c).slice(at, len(part)).to_numpy()[which] for c in ("m", "d", "n"))
            at += len(part)
            yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(d), pa.array(n), pa.array(number.astype(np.int32)), pa.array(x.hash_of(start, size, 2)),
                                              pa.array(x.hash_of(start, size, 3))], names=["m", "d", "n", "number", "h1", "h2"])


def _of_hot_minimizers(stretches: DataFrame) -> DataFrame:
    """m, d, n and mask of stretches whose windows are counted one by one."""
    windows = stretches.mapInArrow(_single, "m long, d long, n long, number int, h1 long, h2 long")
    counts = stored(windows.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).where(F.col("n") >= 2), "hot-windows")
    found = joined(windows, counts.select("h1", "h2"), ["h1", "h2"], hot_keys(counts.select("h1", "h2", "rows"), ["h1", "h2"], "rows"), ["m", "d", "number"])
    return found.groupBy("m", "d", "n").agg(F.bit_or(F.expr("shiftleft(1L, number)")).alias("mask"))


def repeated_masks(docs: DataFrame, most_stretches: int = MOST_STRETCHES) -> tuple[DataFrame, DataFrame]:
    """(m, d, n, mask of its repeated windows) of each stretch that has any, and the places of all that may.

    ``docs``: k1, k2, text."""
    counted = docs.select("text").mapInArrow(_counted, "m long, d long, n long")
    groups = counted.groupBy("m").agg(F.sum("n").alias("n"), F.min("d").alias("d"), (F.min("d") != F.max("d")).alias("mixed"))
    groups = stored(groups.where(F.col("n") >= 2), "minimizers")
    sizes = groups.agg(F.count("*").alias("n"), F.count_if("mixed").alias("mixed")).first()  # two numbers
    repeated_bits, mixed_bits = _filter_of(groups, "m", sizes["n"]), _filter_of(groups.where("mixed"), "m", sizes["mixed"])

    words = docs.select("text").mapInArrow(lambda b: _worded(b, mixed_bits), "m long, d long, n long, words binary")
    words = words.groupBy("m", "d", "words").agg(F.sum("n").alias("n"))
    words = stored(words, "stretches")
    by_m = stored(words.groupBy("m").agg(F.count("*").alias("stretches")), "stretch-counts")
    words = joined(words, by_m, ["m"], hot_keys(by_m, ["m"], "stretches"), ["d"])
    few = words.where(F.col("stretches").between(2, most_stretches)).select("m", "d", "n", "words", F.length("words").alias("size"))
    # so few bytes for so much work that adaptive execution would put them into a few tasks
    shards = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    masks = few.repartition(shards, "m").sortWithinPartitions("m").mapInArrow(_searched, "m long, d long, n long, mask long")
    many = words.where(F.col("stretches") > most_stretches).select("m", "d", "n", "words")
    same = groups.where(~F.col("mixed")).select("m", "d", "n", F.lit(-1).cast("long").alias("mask"))
    masks = stored(masks.unionByName(_of_hot_minimizers(many)).unionByName(same), "repeated")
    return masks, docs.mapInArrow(lambda b: _placed(b, repeated_bits), "m long, d long, k1 long, k2 long, start int, windows int")


_LEFT = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])


def _left(texts: pa.Array, places: pa.Array, with_text: bool) -> pa.Array:
    """What is left of each text without the words of the windows at ``places``."""
    raw, off = flat(texts)
    runs = Runs(raw, off, ~SPACE[raw])
    list_off = np.asarray(places.offsets).astype(np.int64)
    inside = places.values.slice(list_off[0], list_off[-1] - list_off[0])
    doc = np.repeat(np.arange(len(texts)), np.diff(list_off))
    start, mask = inside.field("start").to_numpy(zero_copy_only=False).astype(np.int64), inside.field("mask").to_numpy(zero_copy_only=False).astype(np.int64)
    start = start + runs.off[doc]
    edge = np.zeros(len(runs.codes) + 1, np.int64)
    for k in range(int(mask.max(initial=0)).bit_length()):
        at = start[mask >> k & 1 == 1] + k
        edge += np.bincount(at, minlength=len(edge)) - np.bincount(at + WINDOW, minlength=len(edge))
    kept = np.cumsum(edge)[:-1] == 0
    table, table_off = spaced(runs.distinct)
    out, out_off = spread(table, table_off, runs.codes[kept])
    n_kept = segment_sum(kept.astype(np.int64), runs.off)
    bounds = out_off[np.concatenate([[0], np.cumsum(n_kept)])].tolist()
    data = out.tobytes()
    parts = [data[a:max(a, b - 1)] for a, b in zip(bounds, bounds[1:], strict=False)]
    n = np.diff(runs.off)
    return pa.StructArray.from_arrays([
        pa.array(n), pa.array(n - n_kept), pa.array(parts, pa.binary()).cast(pa.string()) if with_text else pa.nulls(len(parts), pa.string()),
        pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())], fields=list(_LEFT))


def left_over(text: Column, places: Column, with_text: bool = False) -> Column:
    """struct(n_words, n_removed, kept, kept_sha256) of each text; ``places``: (start, mask) of its stretches."""

    @arrow_udf("n_words long, n_removed long, kept string, kept_sha256 string")
    def left(texts: pa.Array, places: pa.Array) -> pa.Array:
        out, at = [], 0
        for part in slices(as_strings(texts)):
            out.append(_left(part, places.slice(at, len(part)), with_text))
            at += len(part)
        return pa.concat_arrays(out) if out else pa.array([], _LEFT)

    return left(text, places)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, most_stretches: int = MOST_STRETCHES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of ``docs``, and the kept text if asked for."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *document_key(F.col(id_col), text))
    masks, places = repeated_masks(own.select("k1", "k2", "text"), most_stretches)
    found = joined(places, masks.select("m", "d", "mask"), ["m", "d"], hot_keys(masks.select("m", "d", "n"), ["m", "d"], "n"), ["k1", "k2", "start"])
    whole = F.expr("shiftleft(1L, windows) - 1")
    found = found.select("k1", "k2", F.struct("start", F.col("mask").bitwiseAND(whole).alias("mask")).alias("place"))
    found = found.groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))  # at most the document's stretches
    nothing = F.array().cast("array<struct<start:int,mask:long>>")
    rows = own.join(found, ["k1", "k2"], "left").select("doc_id", left_over(F.col("text"), F.coalesce("places", nothing), with_text).alias("x"))
    return rows.select("doc_id", "x.n_words", "x.n_removed", "x.kept_sha256", *(["x.kept"] if with_text else []))
