"""The ``rejects`` report: what the other reports could not read.

An unreadable JSON value, comment or status becomes NULL or stays unlabelled in
the reports instead of failing them.  This report counts such values, next to
all values of the same place, so that a loss shows:

* ``dynamic_annotation_fields.value`` by field name, ``versions.object_changes``
  by item type: texts that are no JSON document;
* ``annotations.data`` by annotated type: comments that name a text which the
  YAML doesn't give;
* ``teams.settings`` by team id: listed statuses without a readable id or label
  (a whole section or list of another form counts as one value).

Every source becomes (source, detail, rejected) rows that one aggregate counts:
it combines before its shuffle, which then holds one row for each place and
task.  NULL values are no values; a source without values has no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verilens.functions.json_text import is_malformed
from verilens.functions.strings import strip_ruby_header
from verilens.functions.yaml_text import with_unreadable_comment
from verilens.operators.statuses import listed_statuses

Workspace = dict[str, DataFrame]

REJECT_COLUMNS = ["source", "detail", "n_values", "n_rejected"]


def _values(df: DataFrame, source: str, detail: str, rejected: Column) -> DataFrame:
    return df.select(F.lit(source).alias("source"), F.col(detail).cast("string").alias("detail"),
                     rejected.alias("rejected"))


def _json_values(df: DataFrame, source: str, detail: str, col: str) -> DataFrame:
    return _values(df.filter(F.col(col).isNotNull()), source, detail, is_malformed(F.col(col)))


def _comment_values(ws: Workspace) -> DataFrame:
    a = ws["annotations"]
    a = a.filter((a.annotation_type == "comment") & a.data.isNotNull()) \
        .select("annotated_type", strip_ruby_header(a.data).alias("comment_yaml"))
    return _values(with_unreadable_comment(a, "comment_yaml", "unreadable"), "annotations.data",
                   "annotated_type", F.col("unreadable"))


def _status_values(ws: Workspace) -> DataFrame:
    return _values(listed_statuses(ws["teams"]), "teams.settings", "team_id", ~F.col("readable"))


def rejects(ws: Workspace, ordered: bool = True) -> DataFrame:
    values = reduce(DataFrame.unionByName, [
        _json_values(ws["dynamic_annotation_fields"], "dynamic_annotation_fields.value", "field_name", "value"),
        _json_values(ws["versions"], "versions.object_changes", "item_type", "object_changes"),
        _comment_values(ws),
        _status_values(ws),
    ])
    out = values.groupBy("source", "detail").agg(F.count(F.lit(1)).alias("n_values"),
                                                 F.count_if("rejected").alias("n_rejected"))
    return out.orderBy("source", "detail") if ordered else out
