"""Workspace sources and the report sink.

A workspace is eleven tables; a snapshot is one folder of Parquet tables
(``<dir>/<table>``, or with a suffix).  ``load_workspace`` reads
them with the declared schemas (no inference, so column pruning and filter
pushdown reach the scan), ``validate_workspace`` fails early when a table or
a column the reports need is missing, ``write_report`` writes a typed report
to the shared checkpoint folder (or any path) and reads it back, which also
cuts the lineage of whatever produced it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verilens.schemas import WORKSPACE_SCHEMAS
from verilens.session import shared_dir


def load_workspace(spark: SparkSession, root: str, suffix: str = "") -> dict[str, DataFrame]:
    """Read a workspace snapshot written as Parquet tables.

    ``suffix`` follows each table's name (``".parquet"`` for files named so);
    the store isn't probed, so any path that Spark reads will do."""
    return {name: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}{suffix}")
            for name, schema in WORKSPACE_SCHEMAS.items()}


def write_workspace(ws: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    for name, df in ws.items():
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")


class WorkspaceError(ValueError):
    """A table or column the reports read is missing."""


def missing_columns(ws: dict[str, DataFrame]) -> dict[str, list[str]]:
    problems: dict[str, list[str]] = {}
    for name, schema in WORKSPACE_SCHEMAS.items():
        if name not in ws:
            problems[name] = ["<table>"]
            continue
        have = set(ws[name].columns)
        lost = [f.name for f in schema if f.name not in have]
        if lost:
            problems[name] = lost
    return problems


def validate_workspace(ws: dict[str, DataFrame]) -> DataFrame:
    """Raise ``WorkspaceError`` listing missing tables/columns (schemas compared on
    the driver, no data read); otherwise return one row per non-empty table
    (a one-row probe of each, as cheap as ``SELECT 1 ... LIMIT 1``)."""
    problems = missing_columns(ws)
    if problems:
        raise WorkspaceError("workspace is missing " + "; ".join(
            f"{t}: {', '.join(cs)}" for t, cs in sorted(problems.items())))
    probes = [ws[n].limit(1).select(F.lit(n).alias("table_name"), F.lit(True).alias("readable"))
              for n in WORKSPACE_SCHEMAS]
    out = probes[0]
    for p in probes[1:]:
        out = out.unionByName(p)
    return out


def write_report(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a typed report as Parquet and return it read back.

    Without ``path`` the report goes under the session's shared checkpoint
    folder (``spark.checkpoint.dir``); a cluster without one is an error.
    Column metadata (display formats) travels in the Parquet schema."""
    if path is None:
        path = f"{shared_dir(spark)}/reports/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
