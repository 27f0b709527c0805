"""Embedding near-dedup by an inverted multi-index (operator 10).

Equal vectors of one label become one class with a count.  Unit vectors are cut
into halves; each half has a codebook, and a pair of codewords is a cell of the
product grid.  Every class lies in its nearest cell and visits further cells in
the order of a bound on the distance from it to the cell (the hyperplane between
two codewords), which is what a multi-sequence traversal of the two sorted lists
yields; it stops where the bound exceeds a radius.  That radius is set for the
target recall: the quantile, over a sample, of the bound between pairs exactly
at the threshold, the farthest that may be linked.  ``recall=1`` takes the
distance of the threshold itself, which misses nothing.  What meets in a cell is
verified by the cosine in double precision.

Of two cells only the lower-numbered one's vectors visit the other, so a pair
meets once.  Large cells are split into blocks, visitors go to every block; a
task reduces its links to counts and a forest, never to all pairs.

Fit: codebooks and radius from ``SAMPLE`` classes on the driver (documented
bound); every vector is indexed.

Defined results: a vector that is null, empty, zero or has null or non-finite
components, or whose label is null, links with nothing; vectors of different
lengths don't link; repeated rows are rows of their own and link with each
other; a null vec_id is no candidate for the smallest id, and isn't kept; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verilens.llm.components import components
from verilens.llm.grouped import Forest, changes, dealt, whole_groups
from verilens.session import stored

COSINE, RECALL = 0.93, 0.99
SAMPLE = 20_000
#: Vectors that a cell of one label should hold, and codewords at most.
CELL_ROWS, MOST_CODEWORDS = 256, 256
#: Rows of a block of a cell, and of visitors that one task compares with it.
BLOCK, VISITORS = 1024, 8192


def units(vectors: pa.Array, width: int) -> np.ndarray:
    """Unit vectors in double precision, padded with zeros to ``width``; rows of valid vectors."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = vectors.flatten().to_numpy(zero_copy_only=False)
    out /= np.maximum(np.abs(out).max(axis=1, keepdims=True), 1e-300)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-300)


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(axis=1)[:, None] + (centers * centers).sum(axis=1) - 2 * x @ centers.T)


@dataclass(frozen=True)
class Grid:
    """Two codebooks over halves of ``width`` / 2, and the squared radius of the traversal."""

    width: int
    books: tuple[np.ndarray, np.ndarray]
    stop: float

    def _bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: nearest codeword, and the squared bound on the distance to each codeword's part."""
        out = []
        for half, book in zip((x[:, :self.width // 2], x[:, self.width // 2:]), self.books, strict=True):
            d = _squares(half, book)
            near = d.argmin(axis=1)
            apart = np.sqrt(_squares(book, book))[near]
            own = d[np.arange(len(d)), near][:, None]
            out.append((near, np.where(apart > 0, np.maximum(0, d - own) / (2 * np.maximum(apart, 1e-12)), 0) ** 2))
        return out

    def cells(self, x: np.ndarray) -> np.ndarray:
        (a, _), (b, _) = self._bounds(x)
        return a.astype(np.int64) * len(self.books[1]) + b

    def bound(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The squared bound on the distance from each row to one cell each."""
        (_, first), (_, second) = self._bounds(x)
        rows = np.arange(len(x))
        return first[rows, cell // len(self.books[1])] + second[rows, cell % len(self.books[1])]

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own cell, list of higher-numbered cells to visit) by row, as offsets and cells."""
        (a, first), (b, second) = self._bounds(x)
        k = len(self.books[1])
        own = a.astype(np.int64) * k + b
        order = np.argsort(second, axis=1)
        ranked = np.take_along_axis(second, order, axis=1)
        rows, cells = [], []
        for i in range(first.shape[1]):  # for each codeword of the first half: the nearest of the second, up to the radius
            row, rank = np.nonzero(ranked + first[:, i:i + 1] <= self.stop)
            cell = i * k + order[row, rank]
            higher = cell > own[row]
            rows.append(row[higher])
            cells.append(cell[higher])
        row, cell = np.concatenate(rows), np.concatenate(cells)
        at = np.argsort(row, kind="stable")
        off = np.searchsorted(row[at], np.arange(len(x) + 1))
        return own, off, cell[at]


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means; fewer codewords if there are fewer distinct rows."""
    x = x[np.lexsort(x.T)]
    book = np.unique(x[rng.choice(len(x), min(k, len(x)), replace=False)], axis=0)
    for _ in range(12):
        near = _squares(x, book).argmin(axis=1)
        n = np.bincount(near, minlength=len(book))
        book = np.stack([np.bincount(near, x[:, c], len(book)) for c in range(x.shape[1])], axis=1)[n > 0] / n[n > 0][:, None]
    return book


def fit(x: np.ndarray, codewords: int, cosine: float = COSINE, recall: float = RECALL, seed: int = 10) -> Grid:
    """A grid for unit vectors like those of the sample x."""
    rng, width = np.random.default_rng(seed), x.shape[1]
    books = (_codebook(x[:, :width // 2], codewords, rng), _codebook(x[:, width // 2:], codewords, rng))
    far = 2 - 2 * cosine + 1e-9
    if recall >= 1:
        return Grid(width, books, far)
    grid = Grid(width, books, far)
    away = rng.normal(size=x.shape) * (x.any(axis=0))
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-12)
    other = cosine * x + np.sqrt(1 - cosine * cosine) * away
    mine, its = grid.cells(x), grid.cells(other)
    visitor = np.where((mine <= its)[:, None], x, other)
    bounds = grid.bound(visitor, np.maximum(mine, its))
    return Grid(width, books, min(far, float(np.quantile(bounds, recall))))


def linked(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           cosine: float = COSINE, recall: float = RECALL, cell_rows: int = CELL_ROWS, block: int = BLOCK, visitors: int = VISITORS) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors``."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    valid = v.isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    classes = stored(rows.where(valid).groupBy("label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
                     .withColumn("class", F.monotonically_increasing_id()), "classes")
    facts = classes.agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels"), F.max(F.size("v")).alias("width")).first()
    if facts["n"]:
        met = _meetings(classes, facts, cosine, recall, cell_rows, block, visitors)
        links = met.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
        roots = components(met.select("a", "b")).select(F.col("node").alias("class"), "root")
        whole = classes.select("class", "least_id").join(roots, "class").select("class", "root", "least_id")
        least = whole.groupBy("root").agg(F.min("least_id").alias("component_id"))
        whole = whole.join(least, "root").select("class", "component_id")
        known = (classes.join(links, "class", "left").join(whole, "class", "left")
                 .select(F.col("label").alias("l"), F.col("v").alias("w"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id")))
    else:
        known = classes.select(F.col("label").alias("l"), F.col("v").alias("w"), F.col("n").alias("n_links"), F.col("least_id").alias("component_id"))
    rows = rows.join(known, valid & (F.col("label") == F.col("l")) & (v == F.col("w")), "left")
    component = F.when(F.col("w").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                       F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _meetings(classes: DataFrame, facts, cosine: float, recall: float, cell_rows: int, block: int, visitors: int) -> DataFrame:
    """(a, b, links): links of a class found in one block of a cell (in vectors), and an edge of that block's forest or null."""
    width = facts["width"] + facts["width"] % 2
    each = facts["n"] / max(1, facts["labels"])
    codewords = int(min(MOST_CODEWORDS, max(4, np.sqrt(each / cell_rows))))
    sample = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("v").toArrow()
    grid = fit(units(sample.column("v"), width), codewords, cosine, recall)

    @arrow_udf("cell long, visits array<long>")
    def placed(vectors: pa.Array) -> pa.Array:
        own, off, cells = grid.visits(units(vectors, width))
        return pa.StructArray.from_arrays([pa.array(own), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(cells))], names=["cell", "visits"])

    kind = F.concat_ws("/", "label", F.size("v").cast("string"))
    cells = classes.select("class", "v", "n", kind.alias("kind"), placed(F.col("v")).alias("x")).select("class", "v", "n", "kind", "x.cell", "x.visits")
    cells = stored(cells, "cells")
    own = cells.select("class", "v", "n", "kind", "cell", F.lit(False).alias("visitor"))
    come = cells.select("class", "v", "n", "kind", F.explode("visits").alias("cell"), F.lit(True).alias("visitor"))
    every = own.unionByName(come)
    # blocks of a cell, and parts of its visitors
    counted = (cells.select("kind", "cell", F.lit(0).alias("guest")).unionByName(cells.select("kind", F.explode("visits").alias("cell"), F.lit(1).alias("guest")))
               .groupBy("kind", "cell").agg(F.sum(1 - F.col("guest")).alias("own"), F.sum("guest").alias("guests"))
               .where(F.col("own") > 0)  # nobody meets in a cell without vectors
               .select("kind", "cell", F.ceil(F.col("own") / block).alias("blocks"), F.greatest(F.lit(1), F.ceil(F.col("guests") / visitors)).alias("parts")))
    every = every.join(counted, ["kind", "cell"])
    my_block = F.pmod(F.xxhash64("class"), F.col("blocks"))
    my_part = F.pmod(F.xxhash64("class", F.lit("part")), F.col("parts"))
    up = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    # a vector of the cell: in its block, once for each part, and as a visitor of the higher blocks
    inside = every.where(~F.col("visitor")).withColumn("mine", my_block)
    home = inside.select("class", "v", "n", "kind", "cell", F.col("mine").alias("block"), F.explode(up(F.col("parts"))).alias("part"), F.lit(0).alias("role"))
    higher = inside.where(F.col("mine") < F.col("blocks") - 1).select(
        "class", "v", "n", "kind", "cell", F.explode(F.sequence(F.col("mine") + 1, F.col("blocks") - 1)).alias("block"), my_part.alias("part"), F.lit(1).alias("role"))
    guests = every.where(F.col("visitor")).select("class", "v", "n", "kind", "cell", F.explode(up(F.col("blocks"))).alias("block"), my_part.alias("part"), F.lit(1).alias("role"))
    meeting = home.unionByName(higher).unionByName(guests).withColumn("key", F.xxhash64("kind", "cell", "block", "part"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key"]):
            table = table.combine_chunks()
            x, cls, n = units(table.column("v"), width), table.column("class").to_numpy(), table.column("n").to_numpy()
            role, part = table.column("role").to_numpy(), table.column("part").to_numpy()
            # two cells may share a hash: compare within kind, cell and block only
            place = table.column("kind").combine_chunks().dictionary_encode().indices.to_numpy()
            where = np.stack([place, table.column("cell").to_numpy(), table.column("block").to_numpy(), part], axis=1)
            links, forest = np.zeros(len(x)), Forest(len(x))
            cuts = changes(table, ["key"])
            for a, b in zip([0, *cuts], [*cuts, len(x)], strict=True):
                home = a + np.flatnonzero(role[a:b] == 0)
                for chunk in range(a, b, 2048):
                    other = np.arange(chunk, min(b, chunk + 2048))
                    if not len(home):
                        break
                    hit = x[home] @ x[other].T >= cosine
                    i, j = np.nonzero(hit.T)[::-1]
                    i, j = home[i], other[j]
                    # each pair of home vectors once, in the first part only
                    ok = ((role[j] == 1) | ((j > i) & (part[i] == 0))) & (where[i] == where[j]).all(axis=1) & (cls[i] != cls[j])
                    i, j = i[ok], j[ok]
                    if not len(i):
                        continue
                    links += np.bincount(i, n[j], len(x)) + np.bincount(j, n[i], len(x))
                    # neighbours of one vector: tie them to each other, then one of them to it
                    new = np.concatenate([[True], j[1:] != j[:-1]])
                    forest.join(i[new], j[new])
                    again = np.flatnonzero(~new)
                    ties = np.unique(np.stack([i[again - 1], i[again]], axis=1), axis=0)
                    forest.join(ties[:, 0], ties[:, 1])
            at = np.flatnonzero(links > 0)
            root = np.array([forest.find(k) for k in at.tolist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cls[at]), pa.array(cls[root], mask=root == at), pa.array(links[at].astype(np.int64))], names=["a", "b", "links"])

    meeting = dealt(meeting.select("class", "v", "n", "kind", "cell", "block", "part", "role", "key"), "key", order=("role",))
    return stored(meeting.mapInArrow(compare, "a long, b long, links long"), "meetings")
