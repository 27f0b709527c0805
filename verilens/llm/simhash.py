"""SimHash fingerprints and near-duplicate components (operator 7).

Fingerprints: a bit is set if more than half of the shingles' hashes set it.
Search: two fingerprints of 64 bits that differ in at most 2 agree on two of
four 16-bit blocks, so six keys of 32 bits for each distinct fingerprint bring
every linked pair together.  Members of a key are compared bit-sliced:
fingerprints lie as bit planes, one lane for each member; the planes are XORed
with themselves shifted by d lanes, and two carry-save counters with an
overflow plane add up all the distances of a word of 64 lanes at once.  A word
is abandoned as soon as all its lanes exceed the radius.  Each task reduces its
links to a forest; components come from star rounds over those edges.

Defined results: null or blank text has fingerprint zero and links like any
other; texts with fewer words than a shingle are one shingle; repeated rows
and equal texts share a fingerprint; a null doc_id is no candidate for the
smallest doc_id (a component of such rows only gets null).  Other columns,
whatever their names, are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verilens.llm.components import components
from verilens.llm.hotkeys import hot_keys, joined
from verilens.llm.grouped import Forest, changes, dealt, whole_groups
from verilens.llm.textbatch import as_strings
from verilens.session import stored

SHINGLE_WORDS, RADIUS, SEED = 3, 2, 42
#: Shingles whose bits are counted at once.
STEP = 1 << 16
#: A key with more members than this is dealt anew on its other 32 bits; the
#: members of a second key share 48 bits, so there are at most 65,536 of them.
MOST_MEMBERS = 1024


def fingerprint_of(text: bytes, words_in_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one text in UTF-8."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(words_in_shingle, len(words))
    starts = (ends - lengths)[:len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), STEP):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[i:i + STEP], ends[i:i + STEP], strict=True)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts)).view(np.uint64)[0])


def fingerprint(text: Column, words_in_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """The 64-bit fingerprint of each text as a (signed) long."""

    @arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        found = [fingerprint_of(x.as_buffer().to_pybytes(), words_in_shingle, seed) for x in as_strings(texts)]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return prints(text)


def near_pairs(members: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i, j) of one group whose 64-bit values differ in 1..radius bits.

    Rows of a group lie together.  radius is at most 3 (two counter planes)."""
    n = len(members)
    if n < 2:
        return
    if not 0 <= radius <= 3:
        raise ValueError("two counter planes hold a radius of 3 at most")
    lanes = np.zeros(-(-n // 64) * 64, np.uint64)
    lanes[:n] = members
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits, axis=0, bitorder="little").T.copy().view(np.uint64)  # 64 planes of n / 64 words
    planes = np.concatenate([planes, np.zeros((64, 1), np.uint64)], axis=1)
    size = np.diff(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])))
    left = np.repeat(np.cumsum(size), size) - np.arange(n) - 1  # members after each in its group
    words = planes.shape[1] - 1
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for d in range(1, int(left.max()) + 1):
        ok = np.zeros(words * 64, bool)
        ok[:n] = left >= d
        mask = np.packbits(ok, bitorder="little").view(np.uint64)
        at = np.flatnonzero(mask)
        mask = mask[at]
        q, r = divmod(d, 64)
        one, two, over = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for b in range(64):
            plane = planes[b]
            low = plane[np.minimum(at + q, words)]
            if r:
                low = (low >> np.uint64(r)) | (plane[np.minimum(at + q + 1, words)] << np.uint64(64 - r))
            bit = plane[at] ^ low
            carry = one & bit
            one ^= bit
            over |= two & carry
            two ^= carry
            if b % 4 == 3 and len(at):
                alive = (mask & ~_beyond(one, two, over, radius)) != 0
                if not alive.all():
                    at, mask, one, two, over = at[alive], mask[alive], one[alive], two[alive], over[alive]
                if not len(at):
                    break
        if len(at):
            near = mask & ~_beyond(one, two, over, radius) & full
            hit = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(hit)
            i = at[word] * 64 + lane
            yield i, i + d


def _beyond(one: np.ndarray, two: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count exceeds the radius."""
    return over | ((one | two, two, two & one, np.uint64(0))[radius])


def near_edges(prints: DataFrame, radius: int = RADIUS, most_members: int = MOST_MEMBERS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``, no repeats) that
    connect whatever differs in at most ``radius`` (2 at most) bits."""
    if radius > 2:
        raise ValueError("the keys find pairs within 2 bits")
    fp = F.col("fp")
    blocks = [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    first = [(i, j) for i, j in combinations(range(4), 2)]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.shiftleft(blocks[i], 16) + blocks[j] for i, j in first])).alias("kind", "value"))
    keyed = stored(keyed.select("fp", (F.shiftleft(F.col("kind").cast("long"), 32) + F.col("value")).alias("key")), "keys")
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most_members).select("key")
    cold = keyed.join(hot, "key", "left_anti").select("fp", "key", F.lit(0).cast("long").alias("part"))
    # the other two blocks, by the kind of the first key, then pairs of their four bytes
    rest = F.lit(0).cast("long")
    kind = F.shiftright("key", 32)
    for k, pair in enumerate(first):
        i, j = (x for x in range(4) if x not in pair)
        rest = F.when(kind == k, F.shiftleft(blocks[i], 16) + blocks[j]).otherwise(rest)
    octet = [F.shiftright(F.col("rest"), 8 * i).bitwiseAND(F.lit(0xFF)) for i in range(4)]
    parts = F.array(*[F.lit((k + 1) << 16) + F.shiftleft(octet[i], 8) + octet[j] for k, (i, j) in enumerate(combinations(range(4), 2))])
    warm = (keyed.join(hot, "key", "left_semi").withColumn("rest", rest)
            .select("fp", "key", F.explode(parts.cast("array<long>")).alias("part")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key", "part"]):
            fps = table.column("fp").to_numpy()
            group = np.zeros(len(fps), np.int64)
            group[changes(table, ["key", "part"])] = 1
            forest = Forest(len(fps))
            for i, j in near_pairs(fps.view(np.uint64), np.cumsum(group), radius):
                forest.join(i, j)
            a, b = forest.edges()
            yield pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["a", "b"])

    return dealt(cold.unionByName(warm), "key", "part").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS,
                    radius: int = RADIUS, most_members: int = MOST_MEMBERS, keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp (long), component (long; a
    fingerprint that names the component) and component_id, and the columns in ``keep``."""
    prints = stored(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), words_in_shingle).alias("fp"), *keep), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("rows")), "fingerprints")
    linked = components(near_edges(nodes.select("fp"), radius, most_members)).select(F.col("node").alias("fp"), "root")
    linked = linked.join(nodes.drop("rows"), "fp")
    linked = linked.join(linked.groupBy("root").agg(F.min("least_id").alias("linked_id")), "root").select("fp", "root", "linked_id")
    every = (nodes.join(linked, "fp", "left")
             .select("fp", F.coalesce("root", "fp").alias("component"), F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("linked_id")).alias("component_id")))
    # the rows of a fingerprint that very many texts share are dealt over salts
    found = joined(prints.withColumn("_row", F.monotonically_increasing_id()), every, ["fp"], hot_keys(nodes, ["fp"], "rows"), ["_row"])
    return found.select("doc_id", "fp", "component", "component_id", *prints.columns[2:])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
