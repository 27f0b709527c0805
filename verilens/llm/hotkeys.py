"""Joins of rows with one value for each key, where a few keys may hold most rows.

A key is hot if it has more than a thousandth of all rows, so there are fewer
than a thousand hot keys whatever the table's size; they alone are broadcast.
Their rows are dealt over salts and their values repeated once for each salt;
the rest is joined as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than 1 / HOT_SHARE of all rows is hot; one of fewer rows than this never is.
HOT_SHARE, LEAST_HOT = 1000, 1000


def hot_keys(counts: DataFrame, keys: list[str], n: str) -> DataFrame:
    """The keys with more than a thousandth of all rows, and their salts; fewer than HOT_SHARE rows.

    ``counts`` has one row for each key with its number of rows; it is read twice, so store it before."""
    total = counts.agg(F.sum(n)).first()[0] or 0  # one number
    bound = max(LEAST_HOT, total // HOT_SHARE)
    return counts.where(F.col(n) > bound).select(*keys, F.ceil(F.col(n) / bound).cast("int").alias("salts"))


def joined(rows: DataFrame, values: DataFrame, keys: list[str], hot: DataFrame, spread: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``values`` (one row for each key, no null keys); hot keys by salt.

    ``spread``: columns of ``rows`` whose hash deals the rows of a hot key."""
    hot = F.broadcast(hot)  # fewer than HOT_SHARE rows
    rows = rows.join(hot, keys, "left").withColumn("salt", F.pmod(F.xxhash64(*spread), F.coalesce("salts", F.lit(1)).cast("long"))).drop("salts")
    values = values.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return rows.join(values.withColumn("salt", F.col("salt").cast("long")), [*keys, "salt"]).drop("salt")
