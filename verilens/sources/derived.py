"""A whole workspace derived from the supplied TPC-H-like tables.

The reports need eleven workspace tables; the test data has none of them.
This module derives each one from the supplied parquet tables with plain
projections (one pass per source table, no joins), so every report reads
data whose size grows with the scale factor.  The same derivation is written
as SQL in ``verilens.oracle.workspace_sql`` for the DuckDB oracle; the two
must stay in step (``tests/test_workspace.py`` compares them table by table).

Conventions (``b`` = lineitem, one row for each of its rows):

* ``k`` order key, ``n`` line number, ``p``/``s``/``ts``/``q`` = part,
  supplier, ship date, quantity of that line, ``a`` its annotation id
  (``(k, n)`` is not unique in lineitem, so equal ones are numbered).
* ``item(k) = k - k % 3``: three orders share one item, so every item gets
  several annotations of a kind and "latest"/"first" choices matter.
"""

from __future__ import annotations

from collections.abc import Iterator, MutableMapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verilens.operators.string_agg import ordered_concat
from verilens.schemas import WORKSPACE_SCHEMAS

# Fixed values of the derived workspace (shared with the SQL version).
RUBY_HASH_HEADER = "--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess"
TEAM_SLUG = "demo"
_HASH, _IVARS = "!ruby/hash:ActiveSupport::HashWithIndifferentAccess", "!ruby/hash-with-ivars:ActionController::Parameters"
#: Settings of the teams, in forms that such settings are written in, and what they say.
TEAM_SETTINGS = [
    f"--- {_HASH}\n:media_verification_statuses: {_HASH}\n  :statuses:\n  - :id: undetermined\n    :label: Unstarted\n"
    "  - :id: in_progress\n    :label: In Progress\n  - :id: verified\n    :label: Verified\n",
    f'--- {_IVARS}\nelements:\n  media_verification_statuses: {_HASH}\n    statuses:\n    - id: undetermined\n      label: "\\u2753 Not \\"started\\""\n'
    f"    - {_IVARS}\n      elements:\n        id: in_progress\n        label: 'It''s going on'\nivars:\n  :@permitted: false\n",
    "---\r\nmedia_verification_statuses:\r\n  default: verified\r\n  statuses:\r\n    -\r\n      id: \"verified\"\r\n      label: Checked twice\r\n"
    "        and found true # folded\r\n    - id: needs_review\r\n      label: \"caf\\xe9\\ttab\"\r\n",
    "other: {statuses: [{id: verified, label: no}]}\nmedia_verification_statuses: {label: x, statuses: [{id: verified, label: 'right, [really]'},\n"
    "  {\"id\": in_progress, \"label\": \"on the way\", locales: {en: {label: no}}}]}\n",
    "media_verification_statuses:\n  statuses:\n  - {id: undetermined, label: flow}\n  - id: ~\n    label: no id\n  - id: verified\n    label: [no, text]\n"
    "  - id: needs_review\n    label: first\n  - id: needs_review\n    label: second wins\n",
]
TEAM_VOCABULARY = [
    (1, "undetermined", "Unstarted"), (1, "in_progress", "In Progress"), (1, "verified", "Verified"),
    (2, "undetermined", '❓ Not "started"'), (2, "in_progress", "It's going on"),
    (3, "verified", "Checked twice and found true"), (3, "needs_review", "café\ttab"),
    (4, "verified", "right, [really]"), (4, "in_progress", "on the way"),
    (5, "undetermined", "flow"), (5, "needs_review", "second wins"),
]
#: Listed entries of each form: those of the vocabulary, in form 5 also an id listed twice and what can't be read.
TEAM_LISTED = [3, 2, 2, 2, 5]
#: (team, entry) that can't be read.
TEAM_UNREADABLE = [(5, 2), (5, 3)]
STATUS_IDS = ["undetermined", "in_progress", "verified", "needs_review"]
LANGUAGES = ["en", "es", "fr", "pt"]
RESPONSE_KINDS = ["free_text", "single_choice", "multiple_choice",
                  "geolocation", "datetime", "image_upload"]
RESPONSE_FIELD_TYPES = ["text", "select", "select", "geojson", "datetime", "image"]
PLATFORMS = ["whatsapp", "messenger", "telegram"]
SECOND_PLATFORM = "viber"
REQUEST_TYPES = ['"default_requests"', '"resource_requests"', '"timeout_requests"']
TZ_NAMES = ["GMT", "EAT", "EST"]
TZ_OFFSETS = ["0", "+3", "-5"]
MESSAGE_SEPARATOR = "\n⁣"
COPY_ID_BASE = 10 ** 12         # a repeated (order, line) counts as an order beyond all others
MESSAGE_ID_BASE = 10 ** 15
SMOOCH_USER_ID_BASE = 2 * 10 ** 15
SECOND_USER_ID_BASE = 3 * 10 ** 15
CONVERSATIONS_PER_USER = 3
ORDERS_PER_MEDIA = 8    # project_medias.media_id = o_orderkey div 8 (a part key)
PROJECT_MODULUS = 30    # project ids 25..29 have no project row

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
TS_FORMAT_US = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

NL = "\n"


def _s(c: Column) -> Column:
    return c.cast("string")


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] for a non-negative integer column."""
    out = None
    for i, v in enumerate(values):
        out = (F.when(index == i, F.lit(v)) if out is None
               else out.when(index == i, F.lit(v)))
    return out


def _null() -> Column:
    return F.lit(None).cast("string")


def _item(k: Column) -> Column:
    return k - k % 3


def _jstr(c: Column) -> Column:
    """JSON string literal of a plain (quote- and backslash-free) text."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``b``: one row for each row of lineitem, with a unique annotation id.

    Rows of one (order, line number) are a handful; equal ones may be numbered in any order."""
    b = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"), F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("q"))
    copy = F.row_number().over(Window.partitionBy("k", "n").orderBy("p", "s", "ts", "q")) - 1
    return b.withColumn("a", (copy.cast("long") * COPY_ID_BASE + F.col("k")) * 10 + F.col("n"))


def _conform(df: DataFrame, name: str) -> DataFrame:
    schema = WORKSPACE_SCHEMAS[name]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


# --------------------------------------------------------------------------
# dimension tables


def users(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return _conform(c.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") == 0, F.lit("smooch")).otherwise(F.col("c_name")).alias("login")),
        "users")


def projects(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation")
    return _conform(n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title")),
                    "projects")


def teams(spark, sf_dir):
    r = read_table(spark, sf_dir, "region")
    key = F.col("r_regionkey")
    return _conform(r.select((key + 1).alias("id"), F.concat(F.lit(f"{TEAM_SLUG}-"), _s(key + 1)).alias("slug"),
                             _pick(key % len(TEAM_SETTINGS), TEAM_SETTINGS).alias("settings")), "teams")


def medias(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return _conform(p.select(
        pk.alias("id"),
        _pick(pk % 3, ["Claim", "Link", "UploadedImage"]).alias("type"),
        F.concat(F.lit("https://example.org/"), _s(pk)).alias("url")), "medias")


def tag_texts(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return _conform(p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text")),
                    "tag_texts")


def bot_resources(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    return _conform(s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title")),
                    "bot_resources")


def project_medias(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    return _conform(o.select(
        ok.alias("id"),
        F.date_format("o_orderdate", TS_FORMAT).alias("created_at"),
        F.col("o_custkey").alias("user_id"),
        (ok / ORDERS_PER_MEDIA).cast("long").alias("media_id"),
        (ok % len(TEAM_SETTINGS) + 1).alias("team_id"),
        (ok % PROJECT_MODULUS).alias("project_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("archived")),
        "project_medias")


# --------------------------------------------------------------------------
# facts derived from order lines


def relationships(spark, sf_dir):
    b = order_lines(spark, sf_dir).filter(F.col("s") % 3 < 2)
    k, n = F.col("k"), F.col("n")
    rtype = _pick(n % 3, ["confirmed_sibling", "suggested_sibling", "parent"])
    return _conform(b.select(
        (_item(k) + 3).alias("source_id"),
        _item(k).alias("target_id"),
        F.concat(F.lit("---\n:source: "), rtype, F.lit("\n:target: "), rtype, F.lit("\n"))
        .alias("relationship_type"),
        F.concat(F.date_format("ts", "yyyy-MM"), F.lit("-01 00:00:00")).alias("created_at"),
        F.date_format("ts", TS_FORMAT).alias("updated_at"),
        F.col("s").alias("user_id"),
        F.when(n % 2 == 0, F.col("p") % 150).alias("confirmed_by")), "relationships")


def _line_annotation_branches(b: DataFrame) -> list[DataFrame]:
    """Annotations from order lines, one branch per kind with literal type
    columns: a query that filters on ``annotation_type``/``annotated_type``
    gets the other branches pruned by Catalyst (filter through union +
    constant folding), as a real table scan with pushdown would."""
    k, n, p = F.col("k"), F.col("n"), F.col("p")
    header = F.lit(RUBY_HASH_HEADER + NL)
    comment = F.concat(header, F.lit("text: note "), _s(k), F.lit(NL))
    on_item, on_task, on_media = _item(k), k * 10 + 4, (k / ORDERS_PER_MEDIA).cast("long")

    def branch(cond, annotation_type, annotated_type, annotated_id, data=None, file=None):
        return b.filter(cond).select(
            F.col("a").alias("id"), F.lit(annotation_type).alias("annotation_type"),
            F.lit(annotated_type).alias("annotated_type"), annotated_id.alias("annotated_id"),
            F.lit("User").alias("annotator_type"), (p % 150).alias("annotator_id"),
            (data if data is not None else _null()).alias("data"),
            (file if file is not None else _null()).alias("file"),
            F.date_format("ts", TS_FORMAT).alias("created_at"))

    out = [
        branch(n == 1, "verification_status", "ProjectMedia", on_item),
        branch(n == 2, "tag", "ProjectMedia", on_item,
               F.concat(header, F.lit("tag: "), _s(p), F.lit(NL))),
        branch(n == 3, "comment", "ProjectMedia", on_item, comment),
        branch(n == 4, "task", "ProjectMedia", on_item,
               F.concat(header, F.lit("label: Question "), _s(p % 10), F.lit(NL),
                        F.when(k % 2 == 0, F.lit("fieldset: metadata\n")).otherwise(F.lit("")))),
    ]
    for i, kind in enumerate(RESPONSE_KINDS):
        file = (F.when(p % 2 == 0, F.concat(F.lit('["Image '), _s(k), F.lit('.png"]')))
                if kind == "image_upload" else None)
        out.append(branch((n == 5) & (k % 6 == i), f"task_response_{kind}", "Task", on_task,
                          file=file))
    out += [
        branch((n == 6) & (k % 3 == 0), "language", "ProjectMedia", on_item),
        branch((n == 6) & (k % 3 == 1), "metadata", "ProjectMedia", on_item),
        branch((n == 6) & (k % 3 == 2), "report_design", "ProjectMedia", on_item,
               F.concat(header, F.lit("state: "),
                        F.when(p % 2 == 0, F.lit("published")).otherwise(F.lit("paused")), F.lit(NL))),
        branch((n == 7) & (k % 4 == 0), "metrics", "ProjectMedia", on_item),
        branch((n == 7) & (k % 4 == 1), "metadata", "Media", on_media),
        branch((n == 7) & (k % 4 == 2), "comment", "Task", on_task, comment),
        branch((n == 7) & (k % 4 == 3), "comment", "ProjectMedia", on_item, comment),
    ]
    return out


def _conversation_keys(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "conversations").select("conv_id").distinct()


def _message_created_at(c: Column) -> Column:
    return F.concat(F.lit("2021-01-"), F.lpad(_s(c % 28 + 1), 2, "0"), F.lit(" "),
                    F.lpad(_s(c % 24), 2, "0"), F.lit(":00:00"))


def _message_annotations(spark, sf_dir) -> list[DataFrame]:
    c = F.col("conv_id")
    keys = _conversation_keys(spark, sf_dir)
    targets = [("ProjectMedia", c * 3), ("BotResource", c % 10), ("Team", F.lit(1).cast("long"))]
    return [keys.filter(c % 3 == i).select(
        (c + MESSAGE_ID_BASE).alias("id"), F.lit("smooch").alias("annotation_type"),
        F.lit(annotated_type).alias("annotated_type"), target.alias("annotated_id"),
        F.lit("Bot").alias("annotator_type"), F.lit(None).cast("long").alias("annotator_id"),
        _null().alias("data"), _null().alias("file"),
        _message_created_at(c).alias("created_at"))
        for i, (annotated_type, target) in enumerate(targets)]


def _platform_users(spark, sf_dir) -> DataFrame:
    """One row per platform account: (annotation id, u, platform, client key)."""
    u = _conversation_keys(spark, sf_dir).select(F.floor(F.col("conv_id") / CONVERSATIONS_PER_USER).alias("u")).distinct()
    first = u.select((F.col("u") + SMOOCH_USER_ID_BASE).alias("id"), "u",
                     _pick(F.col("u") % 3, PLATFORMS).alias("platform"),
                     (F.col("u") % 3).alias("client"))
    second = (u.filter(F.col("u") % 5 == 0)
              .select((F.col("u") + SECOND_USER_ID_BASE).alias("id"), "u",
                      F.lit(SECOND_PLATFORM).alias("platform"), F.lit(3).alias("client")))
    return first.unionByName(second)


def _user_annotations(spark, sf_dir) -> DataFrame:
    return _platform_users(spark, sf_dir).select(
        "id", F.lit("smooch_user").alias("annotation_type"),
        F.lit("Team").alias("annotated_type"), F.lit(1).cast("long").alias("annotated_id"),
        F.lit("Bot").alias("annotator_type"), F.lit(None).cast("long").alias("annotator_id"),
        F.lit(None).cast("string").alias("data"), F.lit(None).cast("string").alias("file"),
        F.lit("2021-01-01 00:00:00").alias("created_at"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def annotations(spark, sf_dir):
    b = order_lines(spark, sf_dir)
    parts = (_line_annotation_branches(b) + _message_annotations(spark, sf_dir)
             + [_user_annotations(spark, sf_dir)])
    return _conform(_union(parts), "annotations")


def _metadata_json(kind: str, k: Column, p: Column, ts: Column) -> Column:
    title = F.when(p % 3 != 0, F.concat(F.lit(f'"title":"{kind} title '), _s(k), F.lit('",')))
    return F.concat(
        F.lit("{"), F.coalesce(title, F.lit("")),
        F.lit('"published_at":"'), F.date_format(ts, TS_FORMAT), F.lit('",'),
        F.lit('"description":"About '), _s(k), F.lit('",'),
        F.lit('"author_name":"Author '), _s(p), F.lit('",'),
        F.lit('"author_url":"https://example.org/author/'), _s(p), F.lit('",'),
        F.lit('"archives":{"archive_org":{"location":"https://archive.example.org/'),
        _s(k), F.lit('"}}}'))


def _metrics_json(a: Column, b: Column, c: Column) -> Column:
    return F.concat(F.lit('{"facebook":{"share_count":'), _s(a), F.lit(',"comment_count":'),
                    _s(b), F.lit(',"reaction_count":'), _s(c), F.lit("}}"))


def _response_value(k: Column, p: Column, s: Column, q: Column, ts: Column) -> Column:
    kind = k % 6
    # multiple choice: JSON text of a JSON object (double encoding)
    other = F.when(q > 25, F.concat(F.lit(',\\"other\\":\\"other '), _s(s), F.lit('\\"')))
    multi = F.concat(F.lit('"{\\"selected\\":[\\"choice '), _s(p % 3), F.lit('\\",\\"choice '),
                     _s(p % 3 + 1), F.lit('\\"]'),
                     F.coalesce(other, F.lit(',\\"other\\":null')), F.lit('}"'))
    name = F.when(p % 2 == 0, F.concat(F.lit('\\"name\\":\\"Place '), _s(p), F.lit('\\"')))
    geo = F.concat(F.lit('"{\\"type\\":\\"Feature\\",\\"geometry\\":{\\"type\\":\\"Point\\",'
                         '\\"coordinates\\":['),
                   _s(p % 90), F.lit(".5,-"), _s(s % 180), F.lit('.25]},\\"properties\\":{'),
                   F.coalesce(name, F.lit("")), F.lit('}}"'))
    dt = F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd"), F.lit(" "), _s(q.cast("int") % 24),
                  F.lit(":"), F.lpad(_s(p % 60), 2, "0"), F.lit(" "), _pick(s % 3, TZ_OFFSETS),
                  F.lit(" "), _pick(s % 3, TZ_NAMES), F.lit(" "),
                  F.when(p % 4 == 0, F.lit("notime")).otherwise(F.lit("")), F.lit('"'))
    return (F.when(kind == 0, F.when(k % 12 == 0, F.lit("")).otherwise(
                _jstr(F.concat(F.lit("answer "), _s(k)))))
            .when(kind == 1, _jstr(F.concat(F.lit("option "), _s(p % 5))))
            .when(kind == 2, multi).when(kind == 3, geo).when(kind == 4, dt)
            .otherwise(_jstr(F.concat(F.lit("Image "), _s(k), F.lit(".png")))))


def _field(df: DataFrame, annotation_id, j: int, annotation_type, field_name: str, field_type,
           value=None, value_json=None) -> DataFrame:
    """One attribute-field branch; literal ``field_name`` (and literal types
    where constant) so filters on them prune the other branches."""
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return df.select((annotation_id * 10 + j).alias("id"), annotation_id.alias("annotation_id"),
                     lit(annotation_type).alias("annotation_type"), F.lit(field_name).alias("field_name"),
                     lit(field_type).alias("field_type"),
                     (value if value is not None else _null()).alias("value"),
                     (value_json if value_json is not None else _null()).alias("value_json"))


def _line_fields(b: DataFrame) -> list[DataFrame]:
    k, n, p, s, q, ts, a = (F.col(c) for c in ("k", "n", "p", "s", "q", "ts", "a"))
    qi = q.cast("long")
    vs = "verification_status"
    out = [
        _field(b.filter(n == 1), a, 0, vs, "verification_status_status", "select",
               _jstr(_pick(p % 4, STATUS_IDS))),
        _field(b.filter((n == 1) & (k % 2 == 0)), a, 1, vs, "title", "text",
               _jstr(F.concat(F.lit("Title "), _s(k)))),
        _field(b.filter((n == 1) & (k % 5 == 0)), a, 2, vs, "content", "text",
               _jstr(F.concat(F.lit("Content for "), _s(k)))),
    ]
    for i, kind in enumerate(RESPONSE_KINDS):
        # every other JSON answer is an object whose keys aren't sorted, with blanks and a trailing zero
        value_json = (F.when(k % 24 == 0, F.concat(F.lit('{"type": "te\\\"  xt", "k": '), _s(k), F.lit(', "aa": 1.50, "b": [ ]}')))
                      .when(k % 12 == 0, _jstr(F.concat(F.lit("json answer "), _s(k))))
                      if kind == "free_text" else None)
        out.append(_field(b.filter((n == 5) & (k % 6 == i)), a, 0, f"task_response_{kind}",
                          f"response_{kind}", RESPONSE_FIELD_TYPES[i],
                          _response_value(k, p, s, q, ts), value_json))
    out += [
        _field(b.filter((n == 6) & (k % 3 == 0)), a, 0, "language", "language", "language",
               _jstr(_pick(p % 4, LANGUAGES))),
        _field(b.filter((n == 6) & (k % 3 == 1)), a, 0, "metadata", "metadata_value", "json",
               None, _metadata_json("Item", k, p, ts)),
        _field(b.filter((n == 7) & (k % 4 == 0)), a, 0, "metrics", "metrics_data", "json",
               None, _metrics_json(qi, qi % 10, qi * 2)),
        _field(b.filter((n == 7) & (k % 4 == 0)), a, 1, "metrics", "metrics_data", "json",
               None, _metrics_json(qi % 9, qi + 5, qi * 3 % 11)),
        _field(b.filter((n == 7) & (k % 4 == 1)), a, 0, "metadata", "metadata_value", "json",
               None, _metadata_json("Media", k, p, ts)),
    ]
    return out


def _message_fields(spark, sf_dir) -> list[DataFrame]:
    conv = read_table(spark, sf_dir, "conversations")
    c = F.col("conv_id")
    keys = _conversation_keys(spark, sf_dir)
    a = c + MESSAGE_ID_BASE
    # user turns in turn order; two-level so a very long conversation is not
    # sorted by one task
    turns = ordered_concat(conv.filter(F.col("role") == "user"), ["conv_id"], "turn", "text",
                           MESSAGE_SEPARATOR, "text")
    msgs = keys.join(turns, "conv_id", "left")
    data = F.to_json(F.struct(
        F.struct(_pick(c % 3, PLATFORMS).alias("type"),
                 F.concat(F.lit("m"), _s(c)).alias("originalMessageId")).alias("source"),
        F.when(c % 4 != 0, c % PROJECT_MODULUS).alias("project_id"),
        F.concat(F.lit("u"), _s(F.floor(c / CONVERSATIONS_PER_USER))).alias("authorId"),
        _pick(c % 3, ["en", "es", "pt"]).alias("language"),
        F.col("text").alias("text")), {"ignoreNullFields": "false"})
    return [
        _field(msgs, a, 0, "smooch", "smooch_data", "json", None, data),
        _field(keys, a, 1, "smooch", "smooch_conversation_id", "text",
               _jstr(F.concat(F.lit("c"), _s(c)))),
        _field(keys.filter(c % 2 == 0), a, 2, "smooch", "smooch_resource_id", "text", _s(c % 10)),
        _field(keys.filter(c % 5 != 0), a, 3, "smooch", "smooch_request_type", "text",
               _pick(c % 3, REQUEST_TYPES)),
    ]


def _user_fields(spark, sf_dir) -> list[DataFrame]:
    u, client = F.col("u"), F.col("client")
    client_json = (F.when(client == 0, F.concat(F.lit(',"externalId":"ext'), _s(u), F.lit('"')))
                   .when(client == 1, F.concat(F.lit(',"displayName":"Name '), _s(u), F.lit('"')))
                   .when(client == 2, F.concat(F.lit(',"avatarUrl":"https://avatars.example.org/'),
                                               _s(u), F.lit('.png"')))
                   .otherwise(F.concat(F.lit(',"externalId":"ext'), _s(u), F.lit('b"'))))
    data = F.concat(F.lit('{"id":"u'), _s(u), F.lit('","raw":{"clients":[{"platform":"'),
                    F.col("platform"), F.lit('"'), client_json, F.lit("}]}}"))
    pu = _platform_users(spark, sf_dir)
    a = F.col("id")
    return [
        _field(pu, a, 0, "smooch_user", "smooch_user_data", "json", None, data),
        _field(pu.filter(u % 2 == 0), a, 1, "smooch_user", "smooch_user_slack_channel_url", "text",
               _jstr(F.concat(F.lit("https://slack.example.org/u"), _s(u)))),
    ]


def dynamic_annotation_fields(spark, sf_dir):
    b = order_lines(spark, sf_dir)
    parts = _line_fields(b) + _message_fields(spark, sf_dir) + _user_fields(spark, sf_dir)
    return _conform(_union(parts), "dynamic_annotation_fields")


def versions(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    eid, et = F.col("event_id"), F.col("event_type")
    # odd events touch every item, even ones one in eight, eight at a time
    k = F.when(eid % 2 == 1, F.floor(eid * 3 / 2)).otherwise(F.floor(eid / 16) * 24)
    published = F.when(eid % 3 != 0, F.lit("published")).otherwise(F.lit("paused"))
    # object_changes is JSON text: the YAML newline inside it is backslash + n
    report_change = F.concat(F.lit('{"data":[null,"--- !ruby/hash:X\\nstate: '), published,
                             F.lit("\\nupdated: "), _s(eid), F.lit('\\n"]}'))
    return _conform(e.select(
        eid.alias("id"),
        F.when(et == "purchase", F.lit("DynamicAnnotation::Field")).alias("item_type"),
        F.when(et == "purchase", _s((k * 10 + 1) * 10)).alias("item_id"),
        F.when(et == "view", F.lit("update_projectmedia"))
        .when(et == "click", F.when(eid % 2 == 0, F.lit("create_dynamic"))
              .otherwise(F.lit("update_dynamic")))
        .when(et == "purchase", F.lit("update_dynamicannotationfield"))
        .otherwise(et).alias("event_type"),
        _item(k).alias("associated_id"),
        F.lit("ProjectMedia").alias("associated_type"),
        F.when(eid % 50 == 0, F.lit("bot")).otherwise(_s(F.col("user_id"))).alias("whodunnit"),
        F.when(et == "view", F.when(eid % 2 == 0, F.lit('{"archived":[false,true]}'))
               .otherwise(F.lit('{"archived":[true,false]}')))
        .when(et == "click", report_change)
        .when(et == "purchase", F.lit('{"value":[null,"x"]}'))
        .otherwise(F.lit("{}")).alias("object_changes"),
        F.date_format("ts", TS_FORMAT_US).alias("created_at")), "versions")


BUILDERS = {
    "project_medias": project_medias, "medias": medias, "teams": teams,
    "projects": projects, "users": users, "annotations": annotations,
    "dynamic_annotation_fields": dynamic_annotation_fields, "tag_texts": tag_texts,
    "relationships": relationships, "versions": versions, "bot_resources": bot_resources,
}


class DerivedTables(MutableMapping):
    """The workspace's tables by name; a table is built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._tables = spark, sf_dir, dict.fromkeys(BUILDERS)

    def __getitem__(self, name: str) -> DataFrame:
        if self._tables[name] is None:
            self._tables[name] = BUILDERS[name](self._spark, self._sf_dir)
        return self._tables[name]

    def __setitem__(self, name: str, table: DataFrame) -> None:
        self._tables[name] = table

    def __delitem__(self, name: str) -> None:
        del self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def derive_workspace(spark: SparkSession, sf_dir: str) -> DerivedTables:
    """All eleven workspace tables as lazily built and evaluated DataFrames."""
    return DerivedTables(spark, sf_dir)
