"""The derived workspace as DuckDB SQL (a ``WITH`` prefix for every oracle).

Mirrors ``verilens.sources.derived`` table by table; only functions both
engines share are used (``strftime``/``lpad``/``||``/``json_object``).  The
supplied tables (``lineitem``, ``orders`` ...) are views the oracle runner
registers.
"""

from __future__ import annotations

from verilens.sources import derived as D

FMT = "%Y-%m-%d %H:%M:%S"
FMT_US = "%Y-%m-%dT%H:%M:%S.%f"


def _q(text: str) -> str:
    """SQL string literal (newlines written with chr(10))."""
    parts = text.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(quoted)


def _v(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _case(index: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


HDR = _q(D.RUBY_HASH_HEADER + "\n")
NL = "chr(10)"
ITEM = "(k - k % 3)"
QI = "CAST(trunc(q) AS BIGINT)"


def _metadata_json(kind: str) -> str:
    return (
        "'{' || COALESCE(CASE WHEN p % 3 <> 0 THEN "
        f"'\"title\":\"{kind} title ' || {_v('k')} || '\",' END, '') || "
        f"'\"published_at\":\"' || strftime(ts, '{FMT}') || '\",' || "
        f"'\"description\":\"About ' || {_v('k')} || '\",' || "
        f"'\"author_name\":\"Author ' || {_v('p')} || '\",' || "
        f"'\"author_url\":\"https://example.org/author/' || {_v('p')} || '\",' || "
        "'\"archives\":{\"archive_org\":{\"location\":\"https://archive.example.org/' || "
        f"{_v('k')} || '\"}}}}}}'"
    )


def _metrics_json(a: str, b: str, c: str) -> str:
    return (f"'{{\"facebook\":{{\"share_count\":' || {_v(a)} || ',\"comment_count\":' || "
            f"{_v(b)} || ',\"reaction_count\":' || {_v(c)} || '}}}}'")


_MULTI = (
    "'\"{\\\"selected\\\":[\\\"choice ' || " + _v("p % 3") + " || '\\\",\\\"choice ' || "
    + _v("p % 3 + 1") + " || '\\\"]' || COALESCE(CASE WHEN q > 25 THEN "
    "',\\\"other\\\":\\\"other ' || " + _v("s") + " || '\\\"' END, ',\\\"other\\\":null') "
    "|| '}\"'"
)
_GEO = (
    "'\"{\\\"type\\\":\\\"Feature\\\",\\\"geometry\\\":{\\\"type\\\":\\\"Point\\\","
    "\\\"coordinates\\\":[' || " + _v("p % 90") + " || '.5,-' || " + _v("s % 180")
    + " || '.25]},\\\"properties\\\":{' || COALESCE(CASE WHEN p % 2 = 0 THEN "
    "'\\\"name\\\":\\\"Place ' || " + _v("p") + " || '\\\"' END, '') || '}}\"'"
)
_DT = (
    "'\"' || strftime(ts, '%Y-%m-%d') || ' ' || " + _v(f"{QI} % 24") + " || ':' || lpad("
    + _v("p % 60") + ", 2, '0') || ' ' || " + _case("s % 3", D.TZ_OFFSETS) + " || ' ' || "
    + _case("s % 3", D.TZ_NAMES) + " || ' ' || CASE WHEN p % 4 = 0 THEN 'notime' ELSE '' END"
    " || '\"'"
)
_RESPONSE_VALUE = (
    "CASE k % 6 "
    f"WHEN 0 THEN CASE WHEN k % 12 = 0 THEN '' ELSE '\"answer ' || {_v('k')} || '\"' END "
    f"WHEN 1 THEN '\"option ' || {_v('p % 5')} || '\"' "
    f"WHEN 2 THEN {_MULTI} WHEN 3 THEN {_GEO} WHEN 4 THEN {_DT} "
    f"ELSE '\"Image ' || {_v('k')} || '.png\"' END"
)

_KIND5 = "'task_response_' || " + _case("k % 6", D.RESPONSE_KINDS)

WORKSPACE_CTES = f"""
b AS (
  SELECT k, n, p, s, ts, q, (copy * {D.COPY_ID_BASE} + k) * 10 + n AS a FROM (
    SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_shipdate AS ts, l_quantity AS q,
           CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity) - 1 AS BIGINT) AS copy
    FROM lineitem)
),
users AS (
  SELECT CAST(c_custkey AS BIGINT) AS id,
         CASE WHEN c_custkey = 0 THEN 'smooch' ELSE c_name END AS login
  FROM customer
),
projects AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS title FROM nation),
teams AS (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, '{D.TEAM_SLUG}-' || {_v('r_regionkey + 1')} AS slug,
         {_case(f'(r_regionkey % {len(D.TEAM_SETTINGS)})', D.TEAM_SETTINGS)} AS settings
  FROM region
),
medias AS (
  SELECT CAST(p_partkey AS BIGINT) AS id, {_case('p_partkey % 3', ['Claim', 'Link', 'UploadedImage'])} AS type,
         'https://example.org/' || {_v('p_partkey')} AS url
  FROM part
),
tag_texts AS (SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS text FROM part),
bot_resources AS (SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS title FROM supplier),
project_medias AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id, strftime(o_orderdate, '{FMT}') AS created_at,
         CAST(o_custkey AS BIGINT) AS user_id, CAST(o_orderkey // {D.ORDERS_PER_MEDIA} AS BIGINT) AS media_id,
         CAST(o_orderkey % {len(D.TEAM_SETTINGS)} + 1 AS BIGINT) AS team_id, CAST(o_orderkey % {D.PROJECT_MODULUS} AS BIGINT) AS project_id,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS archived
  FROM orders
),
relationships AS (
  SELECT CAST({ITEM} + 3 AS BIGINT) AS source_id, CAST({ITEM} AS BIGINT) AS target_id,
         '---' || {NL} || ':source: ' || rt || {NL} || ':target: ' || rt || {NL} AS relationship_type,
         strftime(ts, '%Y-%m') || '-01 00:00:00' AS created_at,
         strftime(ts, '{FMT}') AS updated_at,
         CAST(s AS BIGINT) AS user_id,
         CAST(CASE WHEN n % 2 = 0 THEN p % 150 END AS BIGINT) AS confirmed_by
  FROM (SELECT *, {_case('n % 3', ['confirmed_sibling', 'suggested_sibling', 'parent'])} AS rt
        FROM b WHERE s % 3 < 2)
),
conv_keys AS (SELECT DISTINCT conv_id FROM conversations),
platform_users AS (
  SELECT u + {D.SMOOCH_USER_ID_BASE} AS id, u, {_case('u % 3', D.PLATFORMS)} AS platform, u % 3 AS client
  FROM (SELECT DISTINCT conv_id // {D.CONVERSATIONS_PER_USER} AS u FROM conversations)
  UNION ALL
  SELECT u + {D.SECOND_USER_ID_BASE} AS id, u, {_q(D.SECOND_PLATFORM)} AS platform, 3 AS client
  FROM (SELECT DISTINCT conv_id // {D.CONVERSATIONS_PER_USER} AS u FROM conversations) WHERE u % 5 = 0
),
annotations AS (
  SELECT CAST(a AS BIGINT) AS id,
         CASE WHEN n = 1 THEN 'verification_status' WHEN n = 2 THEN 'tag'
              WHEN n = 3 THEN 'comment' WHEN n = 4 THEN 'task' WHEN n = 5 THEN {_KIND5}
              WHEN n = 6 THEN {_case('k % 3', ['language', 'metadata', 'report_design'])}
              ELSE {_case('k % 4', ['metrics', 'metadata', 'comment', 'comment'])} END AS annotation_type,
         CASE WHEN n = 5 OR (n = 7 AND k % 4 = 2) THEN 'Task'
              WHEN n = 7 AND k % 4 = 1 THEN 'Media' ELSE 'ProjectMedia' END AS annotated_type,
         CAST(CASE WHEN n = 5 OR (n = 7 AND k % 4 = 2) THEN k * 10 + 4
              WHEN n = 7 AND k % 4 = 1 THEN k // {D.ORDERS_PER_MEDIA} ELSE {ITEM} END AS BIGINT) AS annotated_id,
         'User' AS annotator_type, CAST(p % 150 AS BIGINT) AS annotator_id,
         CASE WHEN n = 2 THEN {HDR} || 'tag: ' || {_v('p')} || {NL}
              WHEN n = 3 THEN {HDR} || 'text: note ' || {_v('k')} || {NL}
              WHEN n = 4 THEN {HDR} || 'label: Question ' || {_v('p % 10')} || {NL}
                   || CASE WHEN k % 2 = 0 THEN 'fieldset: metadata' || {NL} ELSE '' END
              WHEN n = 6 AND k % 3 = 2 THEN {HDR} || 'state: '
                   || CASE WHEN p % 2 = 0 THEN 'published' ELSE 'paused' END || {NL}
              WHEN n = 7 AND k % 4 >= 2 THEN {HDR} || 'text: note ' || {_v('k')} || {NL}
         END AS data,
         CASE WHEN n = 5 AND k % 6 = 5 AND p % 2 = 0 THEN '["Image ' || {_v('k')} || '.png"]' END AS file,
         strftime(ts, '{FMT}') AS created_at
  FROM b
  UNION ALL
  SELECT CAST(conv_id + {D.MESSAGE_ID_BASE} AS BIGINT), 'smooch',
         {_case('conv_id % 3', ['ProjectMedia', 'BotResource', 'Team'])},
         CAST(CASE conv_id % 3 WHEN 0 THEN conv_id * 3 WHEN 1 THEN conv_id % 10 ELSE 1 END AS BIGINT),
         'Bot', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         '2021-01-' || lpad({_v('conv_id % 28 + 1')}, 2, '0') || ' ' || lpad({_v('conv_id % 24')}, 2, '0') || ':00:00'
  FROM conv_keys
  UNION ALL
  SELECT CAST(id AS BIGINT), 'smooch_user', 'Team', CAST(1 AS BIGINT), 'Bot', CAST(NULL AS BIGINT),
         CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), '2021-01-01 00:00:00'
  FROM platform_users
),
conv_text AS (
  SELECT conv_id, string_agg(text, chr(10) || chr(8291) ORDER BY turn) AS text
  FROM conversations WHERE role = 'user' GROUP BY conv_id
),
dynamic_annotation_fields AS (
  SELECT CAST(a * 10 + j AS BIGINT) AS id, CAST(a AS BIGINT) AS annotation_id, annotation_type,
         field_name, field_type, value, value_json
  FROM (
    SELECT a, 0 AS j, 'verification_status' AS annotation_type,
           'verification_status_status' AS field_name, 'select' AS field_type,
           '"' || {_case('p % 4', D.STATUS_IDS)} || '"' AS value, CAST(NULL AS VARCHAR) AS value_json
    FROM b WHERE n = 1
    UNION ALL
    SELECT a, 1, 'verification_status', 'title', 'text', '"Title ' || {_v('k')} || '"', NULL
    FROM b WHERE n = 1 AND k % 2 = 0
    UNION ALL
    SELECT a, 2, 'verification_status', 'content', 'text', '"Content for ' || {_v('k')} || '"', NULL
    FROM b WHERE n = 1 AND k % 5 = 0
    UNION ALL
    SELECT a, 0, {_KIND5}, 'response_' || {_case('k % 6', D.RESPONSE_KINDS)},
           {_case('k % 6', D.RESPONSE_FIELD_TYPES)}, {_RESPONSE_VALUE},
           CASE WHEN k % 24 = 0 THEN '{{"type": "te\\"  xt", "k": ' || {_v('k')} || ', "aa": 1.50, "b": [ ]}}'
                WHEN k % 12 = 0 THEN '"json answer ' || {_v('k')} || '"' END
    FROM b WHERE n = 5
    UNION ALL
    SELECT a, 0, 'language', 'language', 'language', '"' || {_case('p % 4', D.LANGUAGES)} || '"', NULL
    FROM b WHERE n = 6 AND k % 3 = 0
    UNION ALL
    SELECT a, 0, 'metadata', 'metadata_value', 'json', NULL, {_metadata_json('Item')}
    FROM b WHERE n = 6 AND k % 3 = 1
    UNION ALL
    SELECT a, 0, 'metrics', 'metrics_data', 'json', NULL,
           {_metrics_json(QI, f'{QI} % 10', f'{QI} * 2')}
    FROM b WHERE n = 7 AND k % 4 = 0
    UNION ALL
    SELECT a, 1, 'metrics', 'metrics_data', 'json', NULL,
           {_metrics_json(f'{QI} % 9', f'{QI} + 5', f'{QI} * 3 % 11')}
    FROM b WHERE n = 7 AND k % 4 = 0
    UNION ALL
    SELECT a, 0, 'metadata', 'metadata_value', 'json', NULL, {_metadata_json('Media')}
    FROM b WHERE n = 7 AND k % 4 = 1
    UNION ALL
    SELECT ck.conv_id + {D.MESSAGE_ID_BASE}, 0, 'smooch', 'smooch_data', 'json', NULL,
           CAST(json_object(
             'source', json_object('type', {_case('ck.conv_id % 3', D.PLATFORMS)},
                                   'originalMessageId', 'm' || {_v('ck.conv_id')}),
             'project_id', CASE WHEN ck.conv_id % 4 <> 0 THEN ck.conv_id % {D.PROJECT_MODULUS} END,
             'authorId', 'u' || {_v(f'ck.conv_id // {D.CONVERSATIONS_PER_USER}')},
             'language', {_case('ck.conv_id % 3', ['en', 'es', 'pt'])},
             'text', ct.text) AS VARCHAR)
    FROM conv_keys ck LEFT JOIN conv_text ct ON ct.conv_id = ck.conv_id
    UNION ALL
    SELECT conv_id + {D.MESSAGE_ID_BASE}, 1, 'smooch', 'smooch_conversation_id', 'text',
           '"c' || {_v('conv_id')} || '"', NULL
    FROM conv_keys
    UNION ALL
    SELECT conv_id + {D.MESSAGE_ID_BASE}, 2, 'smooch', 'smooch_resource_id', 'text', {_v('conv_id % 10')}, NULL
    FROM conv_keys WHERE conv_id % 2 = 0
    UNION ALL
    SELECT conv_id + {D.MESSAGE_ID_BASE}, 3, 'smooch', 'smooch_request_type', 'text',
           {_case('conv_id % 3', D.REQUEST_TYPES)}, NULL
    FROM conv_keys WHERE conv_id % 5 <> 0
    UNION ALL
    SELECT id, 0, 'smooch_user', 'smooch_user_data', 'json', NULL,
           '{{"id":"u' || {_v('u')} || '","raw":{{"clients":[{{"platform":"' || platform || '"' ||
           CASE client WHEN 0 THEN ',"externalId":"ext' || {_v('u')} || '"'
                       WHEN 1 THEN ',"displayName":"Name ' || {_v('u')} || '"'
                       WHEN 2 THEN ',"avatarUrl":"https://avatars.example.org/' || {_v('u')} || '.png"'
                       ELSE ',"externalId":"ext' || {_v('u')} || 'b"' END || '}}]}}}}'
    FROM platform_users
    UNION ALL
    SELECT id, 1, 'smooch_user', 'smooch_user_slack_channel_url', 'text',
           '"https://slack.example.org/u' || {_v('u')} || '"', NULL
    FROM platform_users WHERE u % 2 = 0
  )
),
versions AS (
  SELECT CAST(event_id AS BIGINT) AS id,
         CASE WHEN event_type = 'purchase' THEN 'DynamicAnnotation::Field' END AS item_type,
         CASE WHEN event_type = 'purchase' THEN {_v('(k * 10 + 1) * 10')} END AS item_id,
         CASE event_type WHEN 'view' THEN 'update_projectmedia'
              WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'create_dynamic' ELSE 'update_dynamic' END
              WHEN 'purchase' THEN 'update_dynamicannotationfield' ELSE event_type END AS event_type,
         CAST({ITEM} AS BIGINT) AS associated_id,
         'ProjectMedia' AS associated_type,
         CASE WHEN event_id % 50 = 0 THEN 'bot' ELSE {_v('user_id')} END AS whodunnit,
         CASE event_type
              WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN '{{"archived":[false,true]}}'
                                    ELSE '{{"archived":[true,false]}}' END
              WHEN 'click' THEN '{{"data":[null,"--- !ruby/hash:X\\nstate: '
                   || CASE WHEN event_id % 3 <> 0 THEN 'published' ELSE 'paused' END
                   || '\\nupdated: ' || {_v('event_id')} || '\\n"]}}'
              WHEN 'purchase' THEN '{{"value":[null,"x"]}}'
              ELSE '{{}}' END AS object_changes,
         strftime(ts, '{FMT_US}') AS created_at
  FROM (SELECT *, CASE WHEN event_id % 2 = 1 THEN event_id * 3 // 2 ELSE event_id // 16 * 24 END AS k FROM events)
)"""


def with_workspace(*ctes: str, body: str) -> str:
    """``WITH <workspace>, <ctes...> <body>``."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {WORKSPACE_CTES}{extra}\n{body}"
