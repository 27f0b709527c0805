"""The derived workspace is the same in Spark and in the oracle's SQL."""

import pytest

from oracle_util import compare, duck
from sizes import SF_SMALL
from verilens.oracle.workspace_sql import with_workspace
from verilens.schemas import WORKSPACE_SCHEMAS
from verilens.sources.derived import derive_workspace
from verilens.sources.workspace import WorkspaceError, validate_workspace


@pytest.fixture(scope="module")
def ws(spark):
    return derive_workspace(spark, SF_SMALL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("table", list(WORKSPACE_SCHEMAS))
def test_table_matches_sql(ws, con, table):
    assert compare(ws[table], con, with_workspace(body=f"SELECT * FROM {table}")) > 0


@pytest.mark.parametrize("table", list(WORKSPACE_SCHEMAS))
def test_schema(ws, table):
    want = [(f.name, f.dataType) for f in WORKSPACE_SCHEMAS[table]]
    assert [(f.name, f.dataType) for f in ws[table].schema] == want


def test_validate_missing(ws):
    broken = dict(ws)
    del broken["projects"]
    broken["users"] = ws["users"].drop("login")
    with pytest.raises(WorkspaceError, match="projects.*|users: login"):
        validate_workspace(broken)


def test_validate_ok(ws):
    assert {r.table_name for r in validate_workspace(ws).collect()} == set(WORKSPACE_SCHEMAS)
