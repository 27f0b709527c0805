"""The rejects report: unreadable values are counted by place, next to all values."""

import pytest

from verilens.operators.statuses import unreadable_statuses
from verilens.plans.rejects import REJECT_COLUMNS
from verilens.plans.reports import report
from verilens.schemas import WORKSPACE_SCHEMAS

SETTINGS = """---
media_verification_statuses:
  statuses:
  - id: open
    label: Open
  - id: closed
    label: "not closed
"""


def _table(spark, name, rows):
    names = WORKSPACE_SCHEMAS[name].fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], WORKSPACE_SCHEMAS[name])


@pytest.fixture(scope="module")
def workspace(spark):
    ws = {name: _table(spark, name, []) for name in WORKSPACE_SCHEMAS}
    ws["dynamic_annotation_fields"] = _table(spark, "dynamic_annotation_fields", [
        {"id": 1, "field_name": "title", "value": '"a"'}, {"id": 2, "field_name": "title", "value": '"a'},
        {"id": 3, "field_name": "title", "value": None}, {"id": 4, "field_name": "title", "value": ""},
        {"id": 5, "field_name": "content", "value": "{}"}, {"id": 6, "field_name": None, "value": "{"}])
    ws["versions"] = _table(spark, "versions", [
        {"id": 1, "item_type": "Dynamic", "object_changes": '{"a": 1}'},
        {"id": 2, "item_type": "Dynamic", "object_changes": "--- yaml"},
        {"id": 3, "item_type": "Dynamic", "object_changes": None}])
    ws["annotations"] = _table(spark, "annotations", [
        {"id": i, "annotation_type": kind, "annotated_type": place, "data": data} for i, (kind, place, data) in enumerate([
            ("comment", "ProjectMedia", "---\ntext: fine\n"), ("comment", "ProjectMedia", '---\ntext: "open\n'),
            ("comment", "ProjectMedia", "---\ntext: ~\n"), ("comment", "ProjectMedia", None),
            ("comment", "Task", '---\ntext: "quoted"\n'), ("task", "Task", '---\ntext: "open\n')])])
    ws["teams"] = _table(spark, "teams", [{"id": 7, "settings": SETTINGS}, {"id": 8, "settings": None}])
    return ws


def test_rejects_are_counted_by_place(workspace):
    out = report(workspace, "rejects")
    assert out.columns == REJECT_COLUMNS
    assert [tuple(r) for r in out.collect()] == [
        ("annotations.data", "ProjectMedia", 3, 1),
        ("annotations.data", "Task", 1, 0),
        ("dynamic_annotation_fields.value", None, 1, 1),
        ("dynamic_annotation_fields.value", "content", 1, 0),
        ("dynamic_annotation_fields.value", "title", 3, 2),
        ("teams.settings", "7", 2, 1),
        ("versions.object_changes", "Dynamic", 2, 1)]
    assert unreadable_statuses(workspace["teams"]).count() == 1


def test_empty_workspace_has_no_rejects(spark):
    empty = {name: _table(spark, name, []) for name in WORKSPACE_SCHEMAS}
    assert report(empty, "rejects").collect() == []


def test_rejects_are_one_aggregate(workspace):
    plan = report(workspace, "rejects", ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "CartesianProduct" not in plan
