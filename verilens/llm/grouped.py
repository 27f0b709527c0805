"""Groups of rows from sorted Arrow batches, for operators that compare rows of one key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt(df: DataFrame, *keys: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows with equal keys in one partition, next to each other."""
    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows with equal integer keys (never null),
    each with about a batch of rows; one group alone if it is longer."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = changes(batch, keys)
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if len(new):
            cut = int(new[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def changes(table: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers from 1 at which a new group starts."""
    differs = np.zeros(max(0, table.num_rows - 1), bool)
    for k in keys:
        x = table.column(k).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(k).to_numpy()
        differs |= x[1:] != x[:-1]
    return np.flatnonzero(differs) + 1


class Forest:
    """Union-find over the rows of one table: its links shrink to at most one edge for each row."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a, b = self.find(a), self.find(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, its root) for each row that isn't its own root."""
        at = [x for x, p in enumerate(self.parent) if p != x]
        return np.array(at, np.int64), np.array([self.find(x) for x in at], np.int64)
