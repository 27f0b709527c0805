"""Joins by several ids at once, and left joins whose right side is skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of the right side for one key that one task joins; a key with more is dealt over salts.
SALT_ROWS = 100_000


def resolve_roles(df: DataFrame, key: str, roles: dict[str, str], dim: DataFrame, dim_key: str,
                  dim_value: str) -> DataFrame:
    """``df`` plus one column per role: ``roles = {out_col: id_col}``.

    A row that names users in four roles (first archiver, first publisher, ...)
    would need four joins with the users table, each shuffling both sides by a
    different key.  Here each row is stacked into one row per role, joined with
    the dimension once and folded back.  The row's other columns travel with its
    first role only, and an id that is missing or no number (``bot``), which finds
    nothing, is a negative number of its own row, so no NULLs meet in one task.

    ``key`` must identify rows of ``df`` (one row per key)."""
    names = list(roles)
    payload = F.struct(*[F.col(c) for c in df.columns if c != key])
    nowhere = -1 - F.pmod(F.xxhash64(key), F.lit(1 << 40))
    stacked = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("role"), F.coalesce(F.col(roles[n]).cast("string").try_cast("bigint"), nowhere).alias("uid"),
                 (payload if not i else F.lit(None).cast(dict(df.select(payload.alias("x")).dtypes)["x"])).alias("payload"))
        for i, n in enumerate(names)])).alias("_r"))
    d = dim.select(F.col(dim_key).alias("_uid"), F.col(dim_value).alias("_value"))
    joined = stacked.join(d, F.col("_r.uid") == F.col("_uid"), "left")
    folded = joined.groupBy(key).agg(
        F.any_value("_r.payload", True).alias("_payload"),
        *[F.max(F.when(F.col("_r.role") == i, F.col("_value"))).alias(n) for i, n in enumerate(names)])
    return folded.select(key, "_payload.*", *names)


def left_join_skew_safe(left: DataFrame, right: DataFrame, left_key: str, right_key: str, right_keys: DataFrame | None = None,
                        heavy_rows: int = SALT_ROWS, deal_by: str | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` for a right side whose
    keys may be very unevenly spread (one key holding a large share of rows).

    Adaptive execution can split a skewed partition of the left side of a left
    outer join but never of the right side.  So keys with more than ``heavy_rows``
    rows on the right are counted, their right rows are dealt over salts, and their
    left rows are repeated once for each salt; every other key has salt 0.  A
    heavy key has matches, so its repeated rows that meet none are dropped.  The left
    side is read once; the right once for its rows and once for its keys, which
    ``right_keys`` (one column ``right_key``) may give more cheaply, also roughly.

    A row's salt is a hash of ``deal_by``, an id of the right rows (dropped from the
    result), or of all its columns, so a task that runs again deals alike.  Without an id, equal rows meet in one task."""
    keys = right.select(right_key) if right_keys is None else right_keys.select(right_key)
    heavy = keys.groupBy(F.col(right_key).alias("_hk")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy_rows)
    heavy = heavy.select("_hk", F.ceil(F.col("_n") / heavy_rows).cast("int").alias("_salts"))
    more = F.coalesce("_salts", F.lit(1))
    repeated = left.withColumn("_lk", F.col(left_key)).join(heavy, F.col("_lk") == F.col("_hk"), "left").withColumn("_heavy", F.col("_salts").isNotNull())
    repeated = repeated.withColumn("_salt", F.explode(F.sequence(F.lit(0), more - 1))).drop("_hk", "_salts")
    dealt = right.withColumn("_rk", F.col(right_key)).join(heavy, F.col("_rk") == F.col("_hk"), "left")
    row = F.xxhash64(*([deal_by] if deal_by else right.columns))
    dealt = dealt.withColumn("_deal", F.pmod(row, more).cast("int")).drop("_hk", "_salts", *([deal_by] if deal_by else []))
    joined = repeated.join(dealt, (F.col("_lk") == F.col("_rk")) & (F.col("_salt") == F.col("_deal")), "left")
    return joined.where(~F.col("_heavy") | F.col("_rk").isNotNull()).drop("_heavy", "_salt", "_deal", "_lk", "_rk")
