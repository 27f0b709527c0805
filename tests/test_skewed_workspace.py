"""Reports on a workspace where one item holds a third of the annotations and
of the audit log, checked against the DuckDB report SQL over the same
stored tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sizes import SF_SMALL
from oracle_util import compare
from verilens.oracle.reports_sql import REPORT_CTES
from verilens.plans.reports import report
from verilens.schemas import WORKSPACE_SCHEMAS
from verilens.sources.derived import derive_workspace
from verilens.sources.workspace import load_workspace, write_workspace

HOT = 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    ws = derive_workspace(spark, SF_SMALL)
    a = ws["annotations"]
    hot_a = F.when((a.annotated_type == "ProjectMedia") & (a.id % 3 == 0), F.lit(HOT)) \
        .otherwise(a.annotated_id)
    ws["annotations"] = a.withColumn("annotated_id", hot_a)
    v = ws["versions"]
    ws["versions"] = v.withColumn("associated_id", F.when(v.id % 3 == 0, F.lit(HOT))
                                  .otherwise(v.associated_id))
    r = ws["relationships"]
    ws["relationships"] = r.withColumn("target_id", F.when(r.user_id % 3 == 0, F.lit(HOT))
                                       .otherwise(r.target_id))
    root = str(tmp_path_factory.mktemp("skewed"))
    write_workspace(ws, root)
    con = duckdb.connect()
    for name in WORKSPACE_SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}/*.parquet')")
    return load_workspace(spark, root), con


@pytest.mark.parametrize("name,sql", [
    ("items", "SELECT * FROM r_items"),
    ("tasks", "SELECT * FROM r_tasks"),
    ("conversations", "SELECT * EXCLUDE (annotation_id, project_id, annotated_type, resource_id) "
                      "FROM r_conversations"),
])
def test_report_on_hot_item(skewed, name, sql):
    ws, con = skewed
    n = compare(report(ws, name, ordered=False), con, f"WITH {REPORT_CTES}\n{sql}")
    assert n > 0


def test_hot_item_is_hot(skewed):
    ws, _ = skewed
    a = ws["annotations"].filter("annotated_type = 'ProjectMedia'")
    assert a.filter(F.col("annotated_id") == HOT).count() * 4 > a.count()
