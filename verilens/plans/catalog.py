"""Every registered query: a Spark builder and (where SQL can say it) the
DuckDB oracle body, side by side so that column names stay aligned.

Workspace queries derive the workspace from the supplied tables on each call
(``sources.derived``); single-operator queries read the supplied tables
directly.  Keys follow the operator inventory (scans, filters, joins,
aggregates, windows, sorts, scalar functions, intermediate relations,
reports, typing, text parsers).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verilens.functions import strings as S
from verilens.functions.answers import value_source, with_answer
from verilens.functions.json_text import is_malformed, json_path, json_scalar
from verilens.functions.timestamps import with_iso_timestamps
from verilens.functions.yaml_text import with_comment_text, with_task_label
from verilens.operators import topk
from verilens.operators.statuses import label_statuses, status_vocabulary
from verilens.operators.string_agg import ordered_concat
from verilens.operators.typing import typed
from verilens.oracle import reports_sql as Q
from verilens.plans import conversations as C
from verilens.plans import items as I
from verilens.plans import tasks as T
from verilens.plans.reports import report
from verilens.sources.derived import TEAM_LISTED, TEAM_SETTINGS, TEAM_UNREADABLE, derive_workspace, read_table
from verilens.sources.workspace import validate_workspace, write_report

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Builder
    sql: str | None


CATALOG: dict[str, Entry] = {}


def register(key: str, sql: str | None):
    def deco(fn: Callable[..., DataFrame]):
        CATALOG[key] = Entry(fn, None if sql is None else Q.oracle(sql))
        return fn
    return deco


def ws_query(key: str, sql: str | None):
    """Register ``fn(ws)`` as ``(spark, sf_dir) -> fn(derived workspace)``."""
    def deco(fn: Callable[[dict], DataFrame]):
        register(key, sql)(lambda spark, sf_dir: fn(derive_workspace(spark, sf_dir)))
        return fn
    return deco


# ------------------------------------------------------------ sources / sinks

WORKSPACE_NAMES = ["project_medias", "medias", "teams", "projects", "users", "annotations",
                   "dynamic_annotation_fields", "tag_texts", "relationships", "versions",
                   "bot_resources"]


@ws_query("src_workspace", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in WORKSPACE_NAMES))
def _src_workspace(ws):
    parts = [ws[n].agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in WORKSPACE_NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@ws_query("src_validate", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{n}' AS table_name, true AS readable FROM {n} LIMIT 1)"
    for n in WORKSPACE_NAMES))
def _src_validate(ws):
    return validate_workspace(ws)


@register("sink_typed_parquet", "SELECT * FROM r_tasks")
def _sink_typed_parquet(spark, sf_dir):
    df = T.tasks(derive_workspace(spark, sf_dir), ordered=False)
    return write_report(spark, df, "tasks")


@ws_query("sink_empty_typed", "SELECT * EXCLUDE (annotation_id, project_id, annotated_type, "
                              "resource_id) FROM r_conversations WHERE created_at < TIMESTAMP '1900-01-01'")
def _sink_empty_typed(ws):
    out = C.conversations(ws, ordered=False)
    return out.filter(F.col("created_at") < F.lit("1900-01-01").cast("timestamp_ntz"))


# ------------------------------------------------------------------- filters


@ws_query("flt_conjunction", "SELECT id, annotated_id FROM annotations "
                             "WHERE annotation_type = 'comment' AND annotated_type = 'ProjectMedia'")
def _flt_conjunction(ws):
    a = ws["annotations"]
    return a.filter((a.annotation_type == "comment") & (a.annotated_type == "ProjectMedia")) \
        .select("id", "annotated_id")


@ws_query("flt_in_list", "SELECT id, event_type FROM versions "
                         "WHERE event_type IN ('create_dynamic', 'update_dynamic')")
def _flt_in_list(ws):
    v = ws["versions"]
    return v.filter(v.event_type.isin("create_dynamic", "update_dynamic")).select("id", "event_type")


@ws_query("flt_like_line", f"SELECT id FROM annotations WHERE {Q.has_line('data', 'fieldset: metadata')}")
def _flt_like_line(ws):
    a = ws["annotations"]
    return a.filter(S.contains_line(a.data, "fieldset: metadata")).select("id")


@ws_query("flt_like_escaped", "SELECT id FROM versions "
                              "WHERE contains(lower(object_changes), '\\nstate: published\\n')")
def _flt_like_escaped(ws):
    v = ws["versions"]
    return v.filter(F.lower(v.object_changes).contains(I.PUBLISHED_LINE_ESCAPED)).select("id")


@ws_query("flt_like_prefix", "SELECT id, annotation_type FROM annotations "
                             "WHERE annotation_type ILIKE 'task_response_%'")
def _flt_like_prefix(ws):
    a = ws["annotations"]
    return a.filter(a.annotation_type.ilike("task_response_%")).select("id", "annotation_type")


@ws_query("flt_json_equals", "SELECT id FROM versions "
                             "WHERE CAST(json_extract(object_changes, '$.archived') AS VARCHAR) = '[false,true]'")
def _flt_json_equals(ws):
    v = ws["versions"]
    return v.filter(json_path(v.object_changes, "$.archived") == I.ARCHIVED_CHANGE).select("id")


@ws_query("semi_exists", "SELECT id, project_media_id FROM r_status_change_rows")
def _semi_exists(ws):
    return I._status_change_versions(ws).select("id", "project_media_id")


# --------------------------------------------------------------------- joins


@ws_query("join_eav_inner", "SELECT * FROM r_status_fields")
def _join_eav_inner(ws):
    return I.status_fields(ws)


@ws_query("join_inner_on_pred", "SELECT d.annotation_id, a.annotated_id AS project_media_id, d.value_json "
                                "FROM dynamic_annotation_fields d JOIN annotations a ON d.annotation_id = a.id "
                                "AND a.annotation_type = 'metrics' AND a.annotated_type = 'ProjectMedia' "
                                "WHERE d.field_name = 'metrics_data'")
def _join_inner_on_pred(ws):
    a = ws["annotations"]
    a = a.filter((a.annotation_type == "metrics") & (a.annotated_type == "ProjectMedia"))
    f = ws["dynamic_annotation_fields"]
    f = f.filter(f.field_name == "metrics_data")
    return f.join(a, f.annotation_id == a.id).select(
        f.annotation_id, a.annotated_id.alias("project_media_id"), f.value_json)


@ws_query("join_inner_dim", "SELECT * FROM r_tag_texts")
def _join_inner_dim(ws):
    return I.item_tag_texts(ws)


@ws_query("join_left_label", "SELECT pm.id, p.title AS folder FROM project_medias pm "
                             "LEFT JOIN projects p ON p.id = pm.project_id")
def _join_left_label(ws):
    pm, p = ws["project_medias"], ws["projects"]
    return pm.join(p.select(F.col("id").alias("p_id"), F.col("title").alias("folder")),
                   pm.project_id == F.col("p_id"), "left").select(pm.id, "folder")


@ws_query("join_left_two_roles", "SELECT * FROM r_useful_edges")
def _join_left_two_roles(ws):
    return I.useful_relationships(ws)


@ws_query("join_left_right_pred", "SELECT t.id AS task_id, r.id AS response_id FROM annotations t "
                                  "LEFT JOIN annotations r ON r.annotated_type = 'Task' AND r.annotated_id = t.id "
                                  "AND r.annotation_type ILIKE 'task_response_%' "
                                  "WHERE t.annotated_type = 'ProjectMedia' AND t.annotation_type = 'task'")
def _join_left_right_pred(ws):
    a = ws["annotations"]
    t = a.filter((a.annotated_type == "ProjectMedia") & (a.annotation_type == "task")) \
        .select(F.col("id").alias("task_id"))
    r = a.filter((a.annotated_type == "Task") & a.annotation_type.ilike("task_response_%")) \
        .select(F.col("id").alias("response_id"), F.col("annotated_id").alias("r_task"))
    return t.join(r, t.task_id == r.r_task, "left").select("task_id", "response_id")


@ws_query("join_left_left_pred", "SELECT r.id AS response_id, u.login FROM annotations r "
                                 "LEFT JOIN users u ON r.annotator_type = 'User' AND r.annotator_id = u.id "
                                 "WHERE r.annotated_type = 'Task'")
def _join_left_left_pred(ws):
    a = ws["annotations"]
    r = a.filter(a.annotated_type == "Task")
    u = ws["users"].select(F.col("id").alias("u_id"), "login")
    return r.join(u, (r.annotator_type == "User") & (r.annotator_id == u.u_id), "left") \
        .select(r.id.alias("response_id"), "login")


@ws_query("join_self", "SELECT d.annotation_id, s.value AS slack_value FROM dynamic_annotation_fields d "
                       "LEFT JOIN dynamic_annotation_fields s ON s.annotation_id = d.annotation_id "
                       "AND s.field_name = 'smooch_user_slack_channel_url' "
                       "WHERE d.field_name = 'smooch_user_data'")
def _join_self(ws):
    f = ws["dynamic_annotation_fields"]
    d = f.filter(f.field_name == "smooch_user_data").select("annotation_id")
    s = f.filter(f.field_name == "smooch_user_slack_channel_url").select(
        F.col("annotation_id").alias("s_id"), F.col("value").alias("slack_value"))
    return d.join(s, d.annotation_id == s.s_id, "left").select("annotation_id", "slack_value")


@ws_query("join_coalesce_fallback", "SELECT annotation_id, resource_title FROM r_conversations")
def _join_coalesce_fallback(ws):
    return C.conversation_rows(ws).select(F.col("_a_id").alias("annotation_id"), "resource_title")


@ws_query("lookup_status_label", "SELECT ls.project_media_id, COALESCE(v.status_label, ls.status) AS status "
                                 "FROM r_last_statuses ls JOIN project_medias pm ON pm.id = ls.project_media_id "
                                 "LEFT JOIN r_vocab v ON v.team_id = pm.team_id AND v.status_id = ls.status")
def _lookup_status_label(ws):
    ls = I.last_statuses(ws)
    pm = ws["project_medias"].select(F.col("id").alias("pm_id"), F.col("team_id").alias("_team_id"))
    j = ls.join(pm, ls.project_media_id == pm.pm_id).select("project_media_id", "status", "_team_id")
    return label_statuses(j, status_vocabulary(ws["teams"]), "_team_id", "status") \
        .select("project_media_id", "status")


# ---------------------------------------------------------------- aggregates


@ws_query("agg_json_keys", "SELECT json_extract_string(value_json, '$.id') AS id, "
                           "json_extract_string(value_json, '$.raw.clients[0].platform') AS platform, "
                           "COUNT(*) AS n FROM dynamic_annotation_fields "
                           "WHERE field_name = 'smooch_user_data' GROUP BY 1, 2")
def _agg_json_keys(ws):
    f = ws["dynamic_annotation_fields"]
    f = f.filter(f.field_name == "smooch_user_data")
    return f.groupBy(json_path(f.value_json, "$.id").alias("id"),
                     json_path(f.value_json, "$.raw.clients[0].platform").alias("platform")) \
        .agg(F.count(F.lit(1)).alias("n"))


@ws_query("agg_max_text", "SELECT * FROM r_message_data")
def _agg_max_text(ws):
    return C.message_data(ws)


@register("agg_max_json_number", "SELECT user_id, MAX(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) "
                                 "AS max_k FROM events GROUP BY user_id")
def _agg_max_json_number(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.max(json_path(e.props, "$.k").try_cast("bigint")).alias("max_k"))


@ws_query("agg_min_json", "SELECT * FROM r_languages")
def _agg_min_json(ws):
    return I.item_languages(ws)


@ws_query("agg_max_case", "SELECT * FROM r_outcomes")
def _agg_max_case(ws):
    return C.outcomes(ws)


@ws_query("agg_max_coalesce", "SELECT * FROM r_users_platform")
def _agg_max_coalesce(ws):
    return C.platform_users(ws)


@ws_query("agg_max_cast", "SELECT * FROM r_resource_ids")
def _agg_max_cast(ws):
    return C.resource_ids(ws)


@register("agg_group_concat_sorted", "SELECT p_brand, string_agg(p_name, ', ' ORDER BY p_name) AS names "
                                     "FROM part GROUP BY p_brand")
def _agg_group_concat_sorted(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return ordered_concat(p, ["p_brand"], "p_name", "p_name", ", ", "names")


@ws_query("agg_group_concat_by_id", "SELECT * FROM r_merged_comments")
def _agg_group_concat_by_id(ws):
    return I.item_merged_comments(ws)


@ws_query("agg_pivot_fields", """
SELECT md.annotation_id, md.conversation_id, md.project_id, md.author_id, md.language, md.text,
       bi.conversation_id AS billable_conversation_id, ri.id AS resource_id, o.outcome
FROM r_message_data md
LEFT JOIN r_billable_ids bi ON bi.annotation_id = md.annotation_id
LEFT JOIN r_resource_ids ri ON ri.annotation_id = md.annotation_id
LEFT JOIN r_outcomes o ON o.annotation_id = md.annotation_id""")
def _agg_pivot_fields(ws):
    return C.message_attributes(ws).filter("has_data > 0").drop("has_data")


# ------------------------------------------------------------------- windows

_EVENT_RN = ("SELECT user_id, event_id, ts, event_type FROM (SELECT *, ROW_NUMBER() OVER "
             "(PARTITION BY user_id ORDER BY ts {d}, event_id {d}) AS rn FROM events) WHERE rn = 1")


@register("win_latest_per_key", _EVENT_RN.format(d="DESC"))
def _win_latest(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return topk.latest_per_key(e, ["user_id"], ["ts", "event_id"], ["event_id", "ts", "event_type"])


@register("win_first_per_key", _EVENT_RN.format(d="ASC"))
def _win_first(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return topk.first_per_key(e, ["user_id"], ["ts", "event_id"], ["event_id", "ts", "event_type"])


@register("win_first_and_last", """
SELECT f.user_id, f.event_id AS first_event_id, f.ts AS first_ts, l.event_id AS last_event_id, l.ts AS last_ts
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) f
JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) l
  ON f.user_id = l.user_id AND l.rn = 1
WHERE f.rn = 1""")
def _win_first_and_last(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return topk.first_and_last(e, ["user_id"], ["ts", "event_id"], ["event_id", "ts"])


@ws_query("win_sequence_number", "SELECT * FROM r_comments")
def _win_sequence_number(ws):
    return I.item_comments(ws)


@ws_query("win_rank_relationships", "SELECT * FROM r_edges_ranked")
def _win_rank_relationships(ws):
    return I.ranked_edges(ws)


@register("win_rank_ties", "SELECT l_orderkey, l_linenumber, l_shipdate, RANK() OVER (PARTITION BY l_orderkey "
                           "ORDER BY l_shipdate DESC NULLS LAST) AS rank FROM lineitem")
def _win_rank_ties(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return topk.rank_desc(li, ["l_orderkey"], "l_shipdate")


@ws_query("win_latest_status", "SELECT * FROM r_last_statuses")
def _win_latest_status(ws):
    return I.last_statuses(ws)


# --------------------------------------------------------------------- sorts


@ws_query("sort_id_desc", "SELECT id, created_at FROM project_medias ORDER BY id DESC")
def _sort_id_desc(ws):
    return ws["project_medias"].select("id", "created_at").orderBy(F.col("id").desc())


@ws_query("sort_multi_key", "SELECT task_id, item_id, task_or_metadata, label FROM r_tasks "
                            "ORDER BY item_id DESC, task_or_metadata, label NULLS FIRST")
def _sort_multi_key(ws):
    return T.tasks(ws).select("task_id", "item_id", "task_or_metadata", "label")


@ws_query("sort_time_id", "SELECT annotation_id, created_at FROM r_conversations "
                          "ORDER BY created_at DESC, annotation_id DESC")
def _sort_time_id(ws):
    rows = C.conversation_rows(ws)
    return typed(rows.orderBy(F.col("created_at").desc(), F.col("_a_id").desc())
                 .select(F.col("_a_id").alias("annotation_id"), "created_at"))


# ---------------------------------------------------------- scalar functions


@ws_query("json_scalar_decode", "SELECT field_id, json_extract_string(value, '$') AS status FROM r_status_fields")
def _json_scalar_decode(ws):
    return I.status_fields(ws).select("field_id", json_scalar(F.col("value")).alias("status"))


@ws_query("json_path", "SELECT a.id, json_extract_string(d.value_json, '$.title') AS title, "
                       "json_extract_string(d.value_json, '$.archives.archive_org.location') AS archive_url "
                       "FROM dynamic_annotation_fields d JOIN annotations a ON a.id = d.annotation_id "
                       "WHERE d.field_name = 'metadata_value'")
def _json_path(ws):
    f = ws["dynamic_annotation_fields"]
    f = f.filter(f.field_name == "metadata_value")
    a = ws["annotations"].select(F.col("id"))
    return f.join(a, f.annotation_id == a.id).select(
        a.id, json_path(f.value_json, "$.title").alias("title"),
        json_path(f.value_json, "$.archives.archive_org.location").alias("archive_url"))


@ws_query("json_array_index", "SELECT annotation_id, json_extract_string(value_json, "
                              "'$.raw.clients[0].platform') AS platform FROM dynamic_annotation_fields "
                              "WHERE field_name = 'smooch_user_data'")
def _json_array_index(ws):
    f = ws["dynamic_annotation_fields"]
    return f.filter(f.field_name == "smooch_user_data").select(
        "annotation_id", json_path(f.value_json, "$.raw.clients[0].platform").alias("platform"))


@ws_query("coalesce_title", "SELECT pm.id AS item_id, COALESCE(json_extract_string(pmm.metadata_json, '$.title'), "
                            "json_extract_string(mm.metadata_json, '$.title')) AS item_title "
                            "FROM project_medias pm LEFT JOIN r_item_metadata pmm ON pmm.project_media_id = pm.id "
                            "LEFT JOIN r_media_metadata mm ON mm.media_id = pm.media_id")
def _coalesce_title(ws):
    pm = ws["project_medias"].select(F.col("id").alias("item_id"), "media_id")
    pmm = I.item_metadatas(ws).select(F.col("project_media_id").alias("_pmm_id"),
                                      json_path(F.col("metadata_json"), "$.title").alias("_t1"))
    mm = I.media_metadatas(ws).select(F.col("media_id").alias("_mm_id"),
                                      json_path(F.col("metadata_json"), "$.title").alias("_t2"))
    j = pm.join(pmm, pm.item_id == pmm._pmm_id, "left").join(mm, pm.media_id == mm._mm_id, "left")
    return j.select("item_id", F.coalesce("_t1", "_t2").alias("item_title"))


@ws_query("case_simple", "SELECT id, CASE type WHEN 'Claim' THEN 'Text' ELSE type END AS media_type FROM medias")
def _case_simple(ws):
    m = ws["medias"]
    return m.select("id", F.when(m.type == "Claim", F.lit("Text")).otherwise(m.type).alias("media_type"))


@ws_query("case_outcome", "SELECT annotation_id, outcome FROM r_conversations")
def _case_outcome(ws):
    return C.conversation_rows(ws).select(F.col("_a_id").alias("annotation_id"),
                                          F.col("outcome [dictionarytext]").alias("outcome"))


@ws_query("case_null_sentinel", "SELECT id, NULLIF(login, 'smooch') AS login FROM users")
def _case_null_sentinel(ws):
    u = ws["users"]
    return u.select("id", S.null_if_login(u.login).alias("login"))


@ws_query("str_tag_id", "SELECT * FROM r_tags")
def _str_tag_id(ws):
    return I.item_tags(ws)


@ws_query("str_relationship_type", "SELECT * FROM r_edges")
def _str_relationship_type(ws):
    return I.relationship_edges(ws)


@ws_query("str_replace", "SELECT comment_id, comment_yaml FROM r_comment_rows")
def _str_replace(ws):
    return I._comments(ws, "ProjectMedia", "project_media_id").select("comment_id", "comment_yaml")


@ws_query("str_concat_null", "SELECT annotation_id, conversation_id FROM r_message_data")
def _str_concat_null(ws):
    return C.message_data(ws).select("annotation_id", "conversation_id")


@ws_query("str_build_url", "SELECT pm.id AS item_id, '" + I.DEFAULT_ITEM_BASE_URL + "' || t.slug || "
                           "'/media/' || CAST(pm.id AS VARCHAR) AS item_url "
                           "FROM project_medias pm JOIN teams t ON t.id = pm.team_id")
def _str_build_url(ws):
    pm, t = ws["project_medias"], ws["teams"]
    j = pm.join(t.select(F.col("id").alias("t_id"), "slug"), pm.team_id == F.col("t_id"))
    return j.select(pm.id.alias("item_id"),
                    S.build_item_url(I.DEFAULT_ITEM_BASE_URL, F.col("slug"), pm.id).alias("item_url"))


@ws_query("cast_prefix_int", f"SELECT id, {Q.prefix_int('value')} AS n FROM dynamic_annotation_fields")
def _cast_prefix_int(ws):
    f = ws["dynamic_annotation_fields"]
    return f.select("id", S.prefix_int(f.value).alias("n"))


@ws_query("str_last_segment", "SELECT annotation_id, string_split(text, chr(10) || chr(8291))[-1] "
                              "AS last_user_message FROM r_message_data")
def _str_last_segment(ws):
    return C.message_data(ws).select("annotation_id", S.last_segment(F.col("text")).alias("last_user_message"))


@ws_query("ts_iso_parse", "SELECT id, TRY_CAST(created_at AS TIMESTAMP) AS created_at FROM versions "
                          "UNION ALL SELECT id, TRY_CAST(created_at AS TIMESTAMP) FROM annotations")
def _ts_iso_parse(ws):
    rows = ws["versions"].select("id", "created_at").unionByName(ws["annotations"].select("id", "created_at"))
    return with_iso_timestamps(rows, {"created_at": "created_at"})


@ws_query("bad_json", "SELECT field_name, COUNT(*) FILTER (WHERE value IS NOT NULL AND NOT json_valid(value)) "
                      "AS bad_json FROM dynamic_annotation_fields GROUP BY field_name")
def _bad_json(ws):
    f = ws["dynamic_annotation_fields"]
    return f.groupBy("field_name").agg(F.count(F.when(is_malformed(f.value), 1)).alias("bad_json"))


# ---------------------------------------------------------- typing, parsers


@ws_query("typed_projection", "SELECT id AS item_id, TRY_CAST(created_at AS TIMESTAMP) AS item_created_at, "
                              "CAST(archived AS BIGINT) AS item_archived, CAST(media_id AS BIGINT) AS media, "
                              "CAST(user_id AS VARCHAR) AS owner_by FROM project_medias")
def _typed_projection(ws):
    pm = ws["project_medias"]
    return typed(pm.select(F.col("id").alias("item_id"), F.col("created_at").alias("item_created_at"),
                           F.col("archived").alias("item_archived [integer]"),
                           F.col("media_id").alias("media [id] (suffix dropped)"),
                           F.col("user_id").alias("owner_by")))


@ws_query("yaml_comment_text", "SELECT comment_id, " + Q.yaml_key("comment_yaml", "text") +
          " AS text FROM r_comment_rows UNION ALL SELECT comment_id, " +
          Q.yaml_key("comment_yaml", "text") + " FROM r_task_comment_rows")
def _yaml_comment_text(ws):
    rows = I._comments(ws, "ProjectMedia", "k").unionByName(I._comments(ws, "Task", "k"))
    return with_comment_text(rows, "comment_yaml", "text").select("comment_id", "text")


@ws_query("yaml_task_label", "SELECT task_id, label FROM r_tasks")
def _yaml_task_label(ws):
    a = ws["annotations"]
    t = a.filter((a.annotated_type == "ProjectMedia") & (a.annotation_type == "task"))
    # one row per (task, response field), as in the tasks report
    rows = T.task_rows(ws).select("task_id")
    labels = with_task_label(t.select(F.col("id").alias("t_id"), "data"), "data", "label").drop("data")
    return rows.join(labels, rows.task_id == labels.t_id).select("task_id", "label")


@ws_query("yaml_status_vocab", "SELECT * FROM r_vocab")
def _yaml_status_vocab(ws):
    return status_vocabulary(ws["teams"])


def _answer_rows(ws) -> DataFrame:
    a = ws["annotations"]
    r = a.filter((a.annotated_type == "Task") & a.annotation_type.ilike("task_response_%")) \
        .select(F.col("id").alias("r_id"), "file")
    f = ws["dynamic_annotation_fields"]
    j = f.join(r, f.annotation_id == r.r_id)
    return j.select(f.id.alias("field_id"), "annotation_id", "annotation_type", "field_type",
                    value_source(f.value, f.value_json).alias("v"), "file")


def _answers(ws, field_types=None, annotation_type=None) -> DataFrame:
    rows = _answer_rows(ws)
    if field_types:
        rows = rows.filter(F.col("field_type").isin(field_types))
    if annotation_type:
        rows = rows.filter(F.col("annotation_type") == annotation_type)
    return with_answer(rows, "answer", "annotation_id", "annotation_type", "field_type", "v", "file") \
        .select("field_id", "answer")


def _answer_sql(where: str = "") -> str:
    return ("SELECT field_id, answer FROM r_answers a JOIN r_answer_rows r USING (field_id) "
            + (f"WHERE {where}" if where else ""))


@ws_query("fmt_answer", _answer_sql())
def _fmt_answer(ws):
    return _answers(ws)


@ws_query("fmt_json_string", _answer_sql("r.field_type IN ('text', 'language', 'json', 'image_path', 'id')"))
def _fmt_json_string(ws):
    return _answers(ws, ["text", "language", "json", "image_path", "id"])


@ws_query("fmt_image_url", _answer_sql("r.field_type = 'image'"))
def _fmt_image_url(ws):
    return _answers(ws, ["image"])


@ws_query("fmt_select_single", _answer_sql("r.field_type = 'select' AND "
                                           "r.annotation_type = 'task_response_single_choice'"))
def _fmt_select_single(ws):
    return _answers(ws, ["select"], "task_response_single_choice")


@ws_query("fmt_select_multi", _answer_sql("r.field_type = 'select' AND "
                                          "r.annotation_type = 'task_response_multiple_choice'"))
def _fmt_select_multi(ws):
    return _answers(ws, ["select"], "task_response_multiple_choice")


@ws_query("fmt_geo_point", _answer_sql("r.field_type = 'geojson'"))
def _fmt_geo_point(ws):
    return _answers(ws, ["geojson"])


@ws_query("fmt_datetime", _answer_sql("r.field_type = 'datetime'"))
def _fmt_datetime(ws):
    return _answers(ws, ["datetime"])


@ws_query("fmt_value_source", "SELECT field_id, v FROM r_answer_rows")
def _fmt_value_source(ws):
    return _answer_rows(ws).select("field_id", "v")


@ws_query("fmt_task_or_metadata", "SELECT id AS task_id, CASE WHEN " + Q.has_line("data", "fieldset: metadata") +
          " THEN 'metadata' ELSE 'task' END AS kind FROM annotations "
          "WHERE annotated_type = 'ProjectMedia' AND annotation_type = 'task'")
def _fmt_task_or_metadata(ws):
    a = ws["annotations"]
    t = a.filter((a.annotated_type == "ProjectMedia") & (a.annotation_type == "task"))
    return t.select(F.col("id").alias("task_id"), T.task_or_metadata(t.data).alias("kind"))


# ------------------------------------------------- intermediate relations


def _cte(key: str, cte: str, fn: Callable[[dict], DataFrame]) -> None:
    ws_query(key, f"SELECT * FROM {cte}")(fn)


_cte("cte_statuses", "r_statuses", I.statuses)
_cte("cte_last_statuses", "r_last_statuses", I.last_statuses)
_cte("cte_analysis_titles", "r_titles", I.last_analysis_titles)
_cte("cte_analysis_contents", "r_contents", I.last_analysis_contents)
_cte("cte_tags", "r_tags", I.item_tags)
_cte("cte_tag_texts", "r_tag_texts", I.item_tag_texts)
_cte("cte_tag_strings", "r_tag_strings", I.item_tag_strings)
_cte("cte_comments", "r_comments", I.item_comments)
_cte("cte_merged_comments", "r_merged_comments", I.item_merged_comments)
_cte("cte_edges", "r_edges", I.relationship_edges)
_cte("cte_edges_ranked", "r_edges_ranked", I.ranked_edges)
_cte("cte_useful_edges", "r_useful_edges", I.useful_relationships)
_cte("cte_archived_events", "r_archived_events", I.archived_events)
_cte("cte_first_archived", "r_first_archived", I.first_archived_events)
_cte("cte_publish_events", "r_publish_events", I.publish_related_events)
_cte("cte_first_publish", "r_first_publish", I.first_publish_events)
_cte("cte_status_changes", "r_status_changes", I.status_change_events)
_cte("cte_first_status_change", "r_first_status_change", I.first_status_change_events)
_cte("cte_last_status_change", "r_last_status_change", I.last_status_change_events)
_cte("cte_media_metadata", "r_media_metadata", I.media_metadatas)
_cte("cte_languages", "r_languages", I.item_languages)
_cte("cte_item_metadata", "r_item_metadata", I.item_metadatas)
_cte("cte_reports", "r_reports", I.reports)
_cte("cte_last_reports", "r_last_reports", I.last_reports)
_cte("cte_social_metrics", "r_social_metrics", I.social_metrics)
_cte("cte_task_comments", "r_task_comments", T.task_comments)
_cte("cte_first_task_comment", "r_first_task_comment", T.first_task_comments)
_cte("cte_users_platform", "r_users_platform", C.platform_users)
_cte("cte_message_data", "r_message_data", C.message_data)
_cte("cte_billable_ids", "r_billable_ids", C.billable_ids)
_cte("cte_resource_ids", "r_resource_ids", C.resource_ids)
_cte("cte_outcomes", "r_outcomes", C.outcomes)


# ------------------------------------------------------------------- reports


@ws_query("items", "SELECT * FROM r_items ORDER BY item_id DESC")
def _items(ws):
    return report(ws, "items")


@ws_query("tasks", "SELECT * FROM r_tasks ORDER BY item_id DESC, task_or_metadata, label NULLS FIRST")
def _tasks(ws):
    return report(ws, "tasks")


@ws_query("conversations", "SELECT * EXCLUDE (annotation_id, project_id, annotated_type, resource_id) "
                           "FROM r_conversations ORDER BY created_at DESC, annotation_id DESC")
def _conversations(ws):
    return report(ws, "conversations")


# the derived comments all hold one plain line; the constants state what the derived settings list
@ws_query("rejects", f"""
  SELECT source, detail, COUNT(*) AS n_values, COUNT(*) FILTER (rejected) AS n_rejected FROM (
    SELECT 'dynamic_annotation_fields.value' AS source, field_name AS detail, NOT json_valid(value) AS rejected
    FROM dynamic_annotation_fields WHERE value IS NOT NULL
    UNION ALL SELECT 'versions.object_changes', item_type, NOT json_valid(object_changes)
    FROM versions WHERE object_changes IS NOT NULL
    UNION ALL SELECT 'annotations.data', annotated_type, NOT contains(data, chr(10) || 'text: note ')
    FROM annotations WHERE annotation_type = 'comment' AND data IS NOT NULL
    UNION ALL SELECT 'teams.settings', CAST(id AS VARCHAR),
      list_contains({[list(u) for u in TEAM_UNREADABLE]}, [form, unnest(generate_series(1, {TEAM_LISTED}[form]))])
    FROM (SELECT id, (id - 1) % {len(TEAM_SETTINGS)} + 1 AS form FROM teams))
  GROUP BY ALL ORDER BY source, detail""")
def _rejects(ws):
    return report(ws, "rejects")


def queries() -> dict[str, Builder]:
    return {k: e.build for k, e in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in CATALOG.items() if e.sql is not None}
