"""Ordered string aggregation (``GROUP_CONCAT`` in a stated order).

Semantics: values joined by ``sep`` in ascending ``order``; NULL values are
skipped; duplicates kept; a group whose values are all NULL gives NULL.

Scale: a single ``collect_list`` puts a key's whole list in one task before it
is sorted.  The work is done in two levels: each part of a key
(``operators.spread``: a heavy key's rows are cut by the order value) is sorted
and joined by its own task, then the strings of the parts are joined in their order.
The final row is still one string per key (that is the result), but no task
sorts a hot key's rows on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verilens.operators.spread import HEAVY_ROWS, PART, with_parts


def _join_sorted(order: Column, value: Column, sep: str) -> Column:
    items = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["v"]), sep)


def ordered_concat(df: DataFrame, keys: Sequence[str], order: str, value: str, sep: str, out: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """One row for each key: its values as one string.  ``df`` is read twice, the first time for keys and order only."""
    n_values = F.count(value)
    parted = with_parts(df, keys, order, heavy_rows)
    parts = parted.groupBy(*keys, PART).agg(F.when(n_values > 0, _join_sorted(F.col(order), F.col(value), sep)).alias("_text"))
    return parts.groupBy(*keys).agg(F.when(F.count("_text") > 0, _join_sorted(F.col(PART), F.col("_text"), sep)).alias(out))
