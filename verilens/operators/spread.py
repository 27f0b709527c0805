"""Cuts of a heavy key's rows into parts that follow the order of a column.

Where rows of a key must be numbered, ranked or joined in order, a key with
very many rows may not be sorted by one task.  ``with_parts`` counts the rows of
each key and finds its least and greatest value (one aggregate that combines
before the shuffle); the range of a key with more than ``HEAVY_ROWS`` rows is
cut into equal intervals, as many as its rows need, and an interval that still
has so many is cut once more between its own bounds.  Every other key is one part.
Counts, bounds and parts are exact and depend on the data alone, so that a plan
that is read twice or run again cuts alike.  Values that crowd in one interval of
the second cut stay together; one task then sorts them.

Texts are placed by the bytes behind what the key's least and greatest text
share, so texts with a long common start are cut like any others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task sorts, and parts that a heavy key gets for each so many rows.
HEAVY_ROWS, PARTS_EACH = 100_000, 4
#: Bytes of a text that place it.
PLACE_BYTES = 6

_LEVEL = 1 << 30
PART, KEY_ROWS = "_part", "_key_rows"


def _shared_bytes(low: Column, high: Column) -> Column:
    """How many bytes two texts have in common at their start."""
    low, high = F.encode(low, "UTF-8"), F.encode(high, "UTF-8")
    most = F.least(F.length(low), F.length(high))
    return F.when(most == 0, F.lit(0)).otherwise(F.size(F.filter(F.sequence(F.lit(1), most), lambda i: F.substring(low, 1, i) == F.substring(high, 1, i))))


def _number(value: Column, kind: str, skipped: Column) -> Column:
    """A double that rises with the value."""
    if kind == "string":
        part = F.hex(F.substring(F.encode(value, "UTF-8"), skipped + 1, F.lit(PLACE_BYTES)))
        return F.conv(F.rpad(part, 2 * PLACE_BYTES, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind == "timestamp_ntz":
        return value.cast("timestamp").cast("double")
    return value.cast("double")


def same_keys(left: DataFrame, right: DataFrame, names: dict[str, str]) -> Column:
    """Null-safe equality of key columns, ``names``: left name -> right name."""
    out = F.lit(True)
    for a, b in names.items():
        out = out & left[a].eqNullSafe(right[b])
    return out


def _cut(df: DataFrame, keys: Sequence[str], order: str, heavy_rows: int, part: str, rows: str) -> DataFrame:
    """``df`` with the interval of each row of a heavy key (0 in any other key, -1 for a null order), and the heavy key's rows."""
    kind = dict(df.dtypes)[order]
    names = [f"_h{i}" for i in range(len(keys))]
    stats = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        F.count(F.lit(1)).alias(rows), F.min(order).alias("_low"), F.max(order).alias("_high")).where(F.col(rows) > heavy_rows)
    stats = stats.withColumn("_skip", _shared_bytes(F.col("_low"), F.col("_high")) if kind == "string" else F.lit(0))
    stats = stats.select(*names, rows, "_skip", _number(F.col("_low"), kind, F.col("_skip")).alias("_low"), _number(F.col("_high"), kind, F.col("_skip")).alias("_high"))
    joined = df.join(stats, same_keys(df, stats, dict(zip(keys, names, strict=True))), "left")
    parts = F.least(F.ceil(F.col(rows) * PARTS_EACH / heavy_rows), F.lit(_LEVEL - 2))
    share = (_number(F.col(order), kind, F.col("_skip")) - F.col("_low")) / (F.col("_high") - F.col("_low"))
    cut = F.when(F.col(rows).isNull(), 0).when(F.col(order).isNull(), -1).when(F.col("_high") > F.col("_low"), F.least(F.floor(share * parts), parts - 1)).otherwise(0)
    return joined.withColumn(part, cut.cast("long")).drop("_low", "_high", "_skip", *names)


def with_parts(df: DataFrame, keys: Sequence[str], order: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``df`` with ``_part`` (rises with ``order`` inside a key, nulls first; 0 in a key that isn't heavy)
    and ``_key_rows`` (rows of a heavy key, else NULL).  ``df`` is read three times, twice for keys and order only."""
    coarse = _cut(df, keys, order, heavy_rows, "_coarse", KEY_ROWS)
    fine = _cut(coarse, [*keys, "_coarse"], order, heavy_rows, "_fine", "_interval_rows")
    return fine.withColumn(PART, F.col("_coarse") * _LEVEL + F.col("_fine")).drop("_coarse", "_fine", "_interval_rows")
