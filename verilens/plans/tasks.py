"""The ``tasks`` report: one row per task x response x response field.

Tasks are annotations on items; responses are annotations on tasks; answers
are the responses' fields.  All joins are left joins (a task without answers
still has a row).  Predicates that belong to the right side of a left join
are applied to the right side before joining; the one on the left side of
the users join (``annotator_type = 'User'``) stays in the join condition so a
failing row keeps its other columns.  The label is computed once in a
projection and reused by the sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verilens.functions.answers import DEFAULT_ASSET_BASE_URL, value_source, with_answer
from verilens.functions.strings import strip_ruby_header
from verilens.functions.strings import contains_line
from verilens.functions.yaml_text import with_comment_text, with_task_label
from verilens.operators.lookup import left_join_skew_safe
from verilens.operators.topk import first_per_key, row_number
from verilens.operators.typing import typed

Workspace = dict[str, DataFrame]

TASK_COLUMNS = ["task_id", "item_id", "created_at", "task_or_metadata [dictionarytext]", "label",
                "answer", "answered_by", "answered_at", "first_note"]


def _task_comment_rows(ws: Workspace) -> DataFrame:
    a = ws["annotations"]
    a = a.filter((a.annotation_type == "comment") & (a.annotated_type == "Task"))
    return a.select(a.annotated_id.alias("task_id"), a.id.alias("comment_id"),
                    strip_ruby_header(a.data).alias("comment_yaml"))


def task_comments(ws: Workspace) -> DataFrame:
    c = row_number(_task_comment_rows(ws), ["task_id"], ["comment_id"], out="comment_number")
    return c.select("task_id", "comment_number", "comment_yaml")


def first_task_comments(ws: Workspace) -> DataFrame:
    first = first_per_key(_task_comment_rows(ws), ["task_id"], ["comment_id"], ["comment_yaml"])
    return with_comment_text(first, "comment_yaml", "comment").select("task_id", "comment")


def task_or_metadata(data) -> F.Column:
    return F.when(contains_line(data, "fieldset: metadata"), F.lit("metadata")).otherwise(F.lit("task"))


def _task_responses(ws: Workspace) -> DataFrame:
    a = ws["annotations"]
    return a.filter((a.annotated_type == "Task") & a.annotation_type.ilike("task_response_%")).select(
        F.col("id").alias("response_id"), F.col("annotated_id").alias("r_task_id"),
        F.col("annotator_type").alias("r_annotator_type"),
        F.col("annotator_id").alias("r_annotator_id"), F.col("file").alias("r_file"),
        F.col("created_at").alias("answered_at"))


def answered_responses(ws: Workspace, asset_base_url: str = DEFAULT_ASSET_BASE_URL) -> DataFrame:
    """Task responses with their fields, formatted answers and answerer login.

    ``responses LEFT JOIN fields LEFT JOIN users`` is computed (and the
    answers formatted) before the join to tasks: the formatting then runs in
    this subtree's stage, once per field, and not again when the final sort
    samples its input."""
    responses = _task_responses(ws)
    f = ws["dynamic_annotation_fields"].select(
        F.col("id").alias("f_id"), F.col("annotation_id").alias("f_annotation_id"), F.col("annotation_type").alias("f_type"),
        F.col("field_type").alias("f_field_type"),
        value_source(F.col("value"), F.col("value_json")).alias("f_value"))
    users = ws["users"].select(F.col("id").alias("u_id"), F.col("login").alias("answered_by"))
    df = responses.join(f, responses.response_id == f.f_annotation_id, "left")
    df = df.join(users, (df.r_annotator_type == "User") & (df.r_annotator_id == users.u_id), "left")
    df = with_answer(df, "answer", "f_annotation_id", "f_type", "f_field_type", "f_value", "r_file",
                     asset_base_url)
    return df.select("r_task_id", F.xxhash64("response_id", "f_id").alias("r_deal"), "answer", "answered_by", "answered_at")


def task_rows(ws: Workspace, asset_base_url: str = DEFAULT_ASSET_BASE_URL,
              skew_safe: bool = True) -> DataFrame:
    """One row per task x response field.  ``skew_safe`` joins the answers as
    one left join in which a task with a very large share of the responses is
    dealt over salts; it counts the responses of each task before.
    ``skew_safe=False`` uses a plain left join."""
    a = ws["annotations"]
    base = a.filter((a.annotated_type == "ProjectMedia") & (a.annotation_type == "task")).select(
        F.col("id").alias("task_id"), F.col("annotated_id").alias("item_id"),
        F.col("created_at").alias("task_created_at"),
        task_or_metadata(F.col("data")).alias("kind"), "data")
    tasks = with_task_label(base, "data", "label").drop("data")
    notes = first_task_comments(ws).select(F.col("task_id").alias("n_task_id"),
                                           F.col("comment").alias("first_note"))
    answers = answered_responses(ws, asset_base_url)
    if skew_safe:
        df = left_join_skew_safe(tasks, answers, "task_id", "r_task_id", _task_responses(ws), deal_by="r_deal")
    else:
        df = tasks.join(answers, tasks.task_id == answers.r_task_id, "left")
    df = df.join(notes, df.task_id == notes.n_task_id, "left")
    return df.select(F.col("task_id"), F.col("item_id"), F.col("task_created_at").alias("created_at"),
                     F.col("kind").alias("task_or_metadata [dictionarytext]"), F.col("label"),
                     F.col("answer"), F.col("answered_by"), F.col("answered_at"),
                     F.col("first_note"))


def tasks(ws: Workspace, ordered: bool = True, asset_base_url: str = DEFAULT_ASSET_BASE_URL,
          skew_safe: bool = True) -> DataFrame:
    out = typed(task_rows(ws, asset_base_url, skew_safe))
    if ordered:
        out = out.orderBy(F.col("item_id").desc(), F.col("task_or_metadata").asc(),
                          F.col("label").asc())
    return out
