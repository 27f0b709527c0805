"""The ``conversations`` report: one row per tipline message annotation.

The four per-annotation attribute relations (message data, billable id,
resource id, outcome) are one conditional aggregate over the attribute table
grouped by annotation id (a single shuffle instead of four); the message
data must exist (inner join), the others are optional (left joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verilens.functions.json_text import json_path, json_scalar
from verilens.functions.strings import last_segment, prefix_int
from verilens.operators.typing import typed

Workspace = dict[str, DataFrame]

# Fixed values.
OUTCOMES = {'"default_requests"': "submission", '"resource_requests"': "resource",
            '"timeout_requests"': "timeout"}
CLIENT = "$.raw.clients[0]"

CONVERSATION_COLUMNS = ["conversation_id [text]", "user", "created_at", "outcome [dictionarytext]",
                        "item_id", "resource_title", "user_messages", "last_user_message",
                        "conversation_language [text]", "slack_channel_url",
                        "billable_conversation_id [text]"]


def platform_users(ws: Workspace) -> DataFrame:
    """One row per (platform user id, platform): an id on the platform and a
    Slack channel (MAX picks one when several annotations exist)."""
    f = ws["dynamic_annotation_fields"]
    a = ws["annotations"].select(F.col("id").alias("a_id"))
    data = f.filter(f.field_name == "smooch_user_data").select("annotation_id", "value_json")
    slack = f.filter(f.field_name == "smooch_user_slack_channel_url").select(
        F.col("annotation_id").alias("s_annotation_id"), F.col("value").alias("s_value"))
    j = data.join(a, data.annotation_id == a.a_id) \
        .join(slack, F.col("a_id") == slack.s_annotation_id, "left")
    v = F.col("value_json")
    return j.groupBy(json_path(v, "$.id").alias("id"),
                     json_path(v, f"{CLIENT}.platform").alias("platform")).agg(
        F.max(F.coalesce(json_path(v, f"{CLIENT}.externalId"), json_path(v, f"{CLIENT}.displayName"),
                         json_path(v, f"{CLIENT}.avatarUrl"))).alias("user_id_on_platform"),
        F.max(json_scalar(F.col("s_value"))).alias("slack_channel_url"))


def _outcome_of(v) -> F.Column:
    """Request type (a JSON string) -> outcome name; anything else NULL."""
    o = None
    for k, name in OUTCOMES.items():
        o = F.when(v == k, F.lit(name)) if o is None else o.when(v == k, F.lit(name))
    return o


def _field_max(name: str, expr) -> F.Column:
    return F.max(F.when(F.col("field_name") == name, expr))


def message_attributes(ws: Workspace) -> DataFrame:
    """Per message annotation: conversation id, project, author, language,
    text (from the message data), billable id, resource id, outcome."""
    f = ws["dynamic_annotation_fields"]
    f = f.filter(f.field_name.isin("smooch_data", "smooch_conversation_id", "smooch_resource_id",
                                   "smooch_request_type"))
    vj, v = F.col("value_json"), F.col("value")
    return f.groupBy("annotation_id").agg(
        F.count(F.when(F.col("field_name") == "smooch_data", 1)).alias("has_data"),
        _field_max("smooch_data", F.concat(json_path(vj, "$.source.type"), F.lit(":"),
                                           json_path(vj, "$.source.originalMessageId"))
                   ).alias("conversation_id"),
        _field_max("smooch_data", json_path(vj, "$.project_id")).alias("project_id"),
        _field_max("smooch_data", json_path(vj, "$.authorId")).alias("author_id"),
        _field_max("smooch_data", json_path(vj, "$.language")).alias("language"),
        _field_max("smooch_data", json_path(vj, "$.text")).alias("text"),
        _field_max("smooch_conversation_id", F.replace(v, F.lit('"'), F.lit(""))
                   ).alias("billable_conversation_id"),
        _field_max("smooch_resource_id", prefix_int(v)).alias("resource_id"),
        _field_max("smooch_request_type", _outcome_of(v)).alias("outcome"),
    )


def message_data(ws: Workspace) -> DataFrame:
    m = message_attributes(ws)
    return m.filter("has_data > 0").select("annotation_id", "conversation_id", "project_id",
                                           "author_id", "language", "text")


def billable_ids(ws: Workspace) -> DataFrame:
    return _attribute(ws, "smooch_conversation_id", F.replace(F.col("value"), F.lit('"'), F.lit("")),
                      "conversation_id")


def _attribute(ws: Workspace, name: str, expr, out: str) -> DataFrame:
    f = ws["dynamic_annotation_fields"]
    return f.filter(f.field_name == name).groupBy("annotation_id").agg(F.max(expr).alias(out))


def resource_ids(ws: Workspace) -> DataFrame:
    return _attribute(ws, "smooch_resource_id", prefix_int(F.col("value")), "id")


def outcomes(ws: Workspace) -> DataFrame:
    return _attribute(ws, "smooch_request_type", _outcome_of(F.col("value")), "outcome")


def outcome_label(outcome, annotated_type, project_id) -> F.Column:
    """New-style outcome; ``timeout`` means none; older messages fall back to
    what they are attached to."""
    legacy = (F.when(annotated_type == "BotResource", F.lit("resource"))
              .when(annotated_type == "ProjectMedia",
                    F.when(project_id.isNotNull(), F.lit("submission")).otherwise(F.lit("resource"))))
    return (F.when(outcome == "submission", F.lit("submission"))
            .when(outcome == "resource", F.lit("resource"))
            .when(outcome == "timeout", F.lit(None).cast("string"))
            .otherwise(legacy))


def conversation_rows(ws: Workspace) -> DataFrame:
    a = ws["annotations"]
    msgs = a.filter(a.annotation_type == "smooch").select(
        F.col("id").alias("a_id"), F.col("annotated_type").alias("a_type"),
        F.col("annotated_id").alias("a_target"), F.col("created_at").alias("a_created_at"))
    attrs = message_attributes(ws).filter("has_data > 0")
    df = msgs.join(attrs, msgs.a_id == attrs.annotation_id)
    users = platform_users(ws).select(F.col("id").alias("pu_id"), F.col("platform").alias("pu_platform"),
                                      "user_id_on_platform", "slack_channel_url")
    df = df.join(users, df.author_id == users.pu_id, "left")
    br = ws["bot_resources"]
    legacy = br.select(F.col("id").alias("br0_id"), F.col("title").alias("br0_title"))
    current = br.select(F.col("id").alias("br1_id"), F.col("title").alias("br1_title"))
    df = df.join(legacy, (df.a_type == "BotResource") & (df.a_target == legacy.br0_id), "left")
    df = df.join(current, df.resource_id == current.br1_id, "left")
    return df.select(
        F.col("conversation_id").alias("conversation_id [text]"),
        F.concat(F.col("pu_platform"), F.lit(":"), F.col("user_id_on_platform")).alias("user"),
        F.col("a_created_at").alias("created_at"),
        outcome_label(F.col("outcome"), F.col("a_type"), F.col("project_id"))
        .alias("outcome [dictionarytext]"),
        F.when(F.col("a_type") == "ProjectMedia", F.col("a_target")).alias("item_id"),
        F.coalesce(F.col("br1_title"), F.col("br0_title")).alias("resource_title"),
        F.col("text").alias("user_messages"),
        last_segment(F.col("text")).alias("last_user_message"),
        F.col("language").alias("conversation_language [text]"),
        F.col("slack_channel_url"),
        F.col("billable_conversation_id").alias("billable_conversation_id [text]"),
        F.col("a_id").alias("_a_id"))


def conversations(ws: Workspace, ordered: bool = True) -> DataFrame:
    rows = conversation_rows(ws)
    if ordered:
        rows = rows.orderBy(F.col("created_at").desc(), F.col("_a_id").desc())
    return typed(rows.drop("_a_id"))
