"""Plan shape over a stored workspace: filters reach the scans, scans read
only the columns used, and no row-at-a-time Python UDF appears."""

import re

import pytest

from sizes import SF_SMALL
from verilens.functions.timestamps import with_iso_timestamps
from verilens.plans.reports import report
from verilens.sources.derived import derive_workspace
from verilens.sources.workspace import load_workspace, write_workspace


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ws"))
    write_workspace(derive_workspace(spark, SF_SMALL), root)
    return load_workspace(spark, root)


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # no "..." in scans
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["items", "tasks", "conversations"])
def test_report_plan(stored, name):
    plan = _plan(report(stored, name))
    assert "BatchEvalPython" not in plan          # no row-at-a-time Python UDF
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert scans
    ann = [s for s in scans if "annotation_type" in s and "annotated_type" in s]
    assert any("PushedFilters: [" in s and "EqualTo(annotated_type" in s or "In(annotation_type" in s
               or "EqualTo(annotation_type" in s for s in ann)


def test_items_read_schema_pruned(stored):
    plan = _plan(report(stored, "items"))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*?>)", plan)
    assert schemas
    # the items report never reads an annotation's file nor a field's type
    assert not any(",file:" in s or "<file:" in s for s in schemas)
    assert not any("field_type:" in s for s in schemas)
    # the team settings are read only by the status vocabulary scan
    assert all(s == "struct<id:bigint,settings:string>" for s in schemas if "settings:" in s)


def test_timestamps_leave_methods_that_the_jvm_compiles(spark):
    df = spark.range(3).selectExpr("id", *[f"concat('2020-01-0', id, ' 00:00:00') AS c{k}" for k in range(4)])
    out = with_iso_timestamps(df, {f"c{k}": f"c{k}" for k in range(4)})
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", out._jdf.queryExecution().explainString(mode))
    assert sizes and max(map(int, sizes)) < 8000   # longer ones stay interpreted, and every row with them


def test_items_are_joined_once_for_the_sort(stored):
    lines = [line.strip(" :+-*()0123456789") for line in _plan(report(stored, "items")).split("\n")]
    at = next(i for i, line in enumerate(lines) if line.startswith("Exchange rangepartitioning"))
    # the sample for the ranges reads an exchange's output, it doesn't run the joins
    below = next(line for line in lines[at + 1:] if line.startswith(("Exchange", "SortMergeJoin", "BroadcastHashJoin")))
    assert below.startswith("Exchange hashpartitioning(item_id")
