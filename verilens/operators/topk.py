"""Top-1 per key, first-and-last per key, rank-1 ties, and row numbers.

Every report picks "the latest status", "the first archive event" and the
like.  Written as ``ROW_NUMBER() ... = 1`` that is a shuffle plus a sort of
each key's rows in one task, so a key holding a third of the data lands in
one task.  Here top-1 is an aggregate instead: ``max_by``/``min_by`` over a
struct of the wanted columns, ordered by a struct of the order columns.  It
combines map-side (one row per key per partition leaves the mapper), so a hot
key is one row for each partition.  A struct buffer makes Spark sort each map
partition by key first (a sort aggregate); finding the key's greatest order
with a hash aggregate and joining the rows back was slower (README).

``row_number`` and ``rank_desc`` (needed only where a relation exposes the
number itself) work inside parts of a key that follow the order; a key of many
rows has many parts, and prefix sums of their counts make the numbers whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verilens.operators.spread import HEAVY_ROWS, KEY_ROWS, PART, same_keys, with_parts

Cols = Sequence[str | Column]


def _cols(cs: Cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Cols,
                   values: Sequence[str]) -> DataFrame:
    """One row per key: ``values`` of the row with the greatest ``order``
    (ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1)."""
    return _pick(df, keys, order, values, F.max_by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Cols,
                  values: Sequence[str]) -> DataFrame:
    """One row per key: ``values`` of the row with the smallest ``order``."""
    return _pick(df, keys, order, values, F.min_by)


def _pick(df, keys, order, values, fn) -> DataFrame:
    top = fn(F.struct(*[F.col(v) for v in values]), F.struct(*_cols(order)))
    return df.groupBy(*keys).agg(top.alias("_top")).select(*keys, *[f"_top.{v}" for v in values])


def first_and_last(df: DataFrame, keys: Sequence[str], order: Cols, values: Sequence[str],
                   first_prefix: str = "first_", last_prefix: str = "last_") -> DataFrame:
    """First and last row per key in one aggregate (one shuffle, no sort)."""
    payload = F.struct(*[F.col(v) for v in values])
    o = F.struct(*_cols(order))
    agg = df.groupBy(*keys).agg(F.min_by(payload, o).alias("_f"), F.max_by(payload, o).alias("_l"))
    return agg.select(*keys, *[F.col(f"_f.{v}").alias(first_prefix + v) for v in values],
                      *[F.col(f"_l.{v}").alias(last_prefix + v) for v in values])


def top_rank_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows with ``RANK() OVER (PARTITION BY keys ORDER BY order DESC) = 1``:
    every row whose ``order`` equals the key's maximum (ties all kept; when
    every ``order`` of a key is NULL, all its rows tie).

    The maximum is an aggregate; the rows are then found with an equi-join on
    (keys, order), so a hot key is spread over partitions by its order values.
    """
    best = df.groupBy(*keys).agg(F.max(order).alias("_best"))
    cond = [df[k] == best[k] for k in keys] + [df[order].eqNullSafe(best["_best"])]
    return df.join(best, cond, "left_semi")


def _with_earlier_parts(numbered: DataFrame, parted: DataFrame, keys: list[str], local: str, out: str, descending: bool) -> DataFrame:
    """``local`` (counted inside each part) plus the rows of the heavy key's parts before it.

    Only heavy keys have more than one part: the prefix sums run over the counts of their parts."""
    names = [f"_p{i}" for i in range(len(keys))]
    counts = parted.where(F.col(KEY_ROWS).isNotNull()).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(PART).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*names).orderBy(F.col("_of").desc() if descending else F.col("_of")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*names, "_of", F.sum("_n").over(before).alias("_before"))
    joined = numbered.join(offsets, same_keys(numbered, offsets, dict(zip([*keys, PART], [*names, "_of"], strict=True))), "left")
    return joined.withColumn(out, F.col(local) + F.coalesce("_before", F.lit(0))).drop(*names, "_of", "_before", local)


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", descending: bool = False,
               from_the_end: str | None = None, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` without one task for each key.

    Rows are numbered inside the parts of their key (``operators.spread``) and the
    rows of earlier parts are added.  ``from_the_end`` names a second number that
    counts from the key's last row: rows of the key + 1 - number.  ``order`` must be
    unique within a key (add a tie-breaker) for the numbers to be deterministic.
    ``df`` is read three times, twice for keys and order only: store a costly one before."""
    keys = list(keys)
    parted = with_parts(df, keys, order[0], heavy_rows)
    part = Window.partitionBy(*keys, PART)
    ordering = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    numbered = parted.withColumn("_local", F.row_number().over(part.orderBy(*ordering)))
    if from_the_end:  # a key that isn't heavy is one part
        numbered = numbered.withColumn("_all", F.coalesce(KEY_ROWS, F.count(F.lit(1)).over(part)))
    numbered = _with_earlier_parts(numbered, parted, keys, "_local", out, descending)
    if from_the_end:
        numbered = numbered.withColumn(from_the_end, F.col("_all") + 1 - F.col(out)).drop("_all")
    return numbered.drop(PART, KEY_ROWS)


def rank_desc(df: DataFrame, keys: Sequence[str], order: str, out: str = "rank", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY order DESC)`` (NULLs last).

    Equal values are in one part of their key, so a rank inside the part plus the
    rows of the parts above it is the rank in the key."""
    keys = list(keys)
    parted = with_parts(df, keys, order, heavy_rows)
    local = F.rank().over(Window.partitionBy(*keys, PART).orderBy(F.col(order).desc_nulls_last()))
    return _with_earlier_parts(parted.withColumn("_local", local), parted, keys, "_local", out, True).drop(PART, KEY_ROWS)
