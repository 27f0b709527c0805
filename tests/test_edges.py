"""Hand-written edge rows for the semantic decisions (FIXTURES.md section E)."""

from pyspark.sql import functions as F

from verilens.functions.strings import prefix_int, tag_id
from verilens.plans import items as I
from verilens.schemas import WORKSPACE_SCHEMAS

H = "--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess\n"


def _ws(spark, **tables):
    ws = {}
    for name, schema in WORKSPACE_SCHEMAS.items():
        ws[name] = spark.createDataFrame(tables.get(name, []), schema)
    return ws


def test_prefix_int(spark):
    df = spark.createDataFrame([("12\nx",), ("abc",), (None,), ("  -7z",), ("+3",), ("",)], "v string")
    assert [r.n for r in df.select(prefix_int(F.col("v")).alias("n")).collect()] == [12, 0, None, -7, 3, 0]


def test_tag_without_needle(spark):
    # no "tag: " in the text: the SQL arithmetic reads from character 5
    df = spark.createDataFrame([(H + "tag: 42\n",), ("abcd9x",), ("abcdx",)], "d string")
    assert [r.t for r in df.select(tag_id(F.col("d")).alias("t")).collect()] == [42, 9, 0]


def test_report_state_case_insensitive(spark):
    a = [(1, "report_design", "ProjectMedia", 7, "User", 1, "x\nState: Published\n", None, "2020-01-01"),
         (2, "report_design", "ProjectMedia", 8, "User", 1, "x\nstate: paused\n", None, "2020-01-01")]
    ws = _ws(spark, annotations=a)
    got = {r.project_media_id: r.status for r in I.last_reports(ws).collect()}
    assert got == {7: "published", 8: "paused"}


def test_escaped_newline_only(spark):
    v = [(1, None, None, "create_dynamic", 5, "ProjectMedia", "3",
          '{"data":"x\\nstate: published\\ny"}', "2020-01-01 00:00:00"),
         (2, None, None, "create_dynamic", 6, "ProjectMedia", "3",
          '{"data":"x\nstate: published\ny"}', "2020-01-01 00:00:00")]
    ws = _ws(spark, versions=v, users=[(3, "ann")])
    got = {r.project_media_id: r.login for r in I.first_publish_events(ws).collect()}
    assert got == {5: "ann"}


def test_metrics_numeric_max_and_bot_user(spark):
    a = [(1, "metrics", "ProjectMedia", 7, "User", 1, None, None, "2020-01-01")]
    f = [(10, 1, "metrics", "metrics_data", "json", None, '{"facebook":{"share_count":9}}'),
         (11, 1, "metrics", "metrics_data", "json", None, '{"facebook":{"share_count":10}}')]
    ws = _ws(spark, annotations=a, dynamic_annotation_fields=f)
    assert I.social_metrics(ws).first().share_count == 10
    v = [(1, None, None, "update_projectmedia", 7, "ProjectMedia", "bot",
          '{"archived":[false,true]}', "2020-01-01 00:00:00")]
    ws = _ws(spark, versions=v, users=[(3, "ann")])
    row = I.first_archived_events(ws).first()
    assert (row.project_media_id, row.login) == (7, None)


def test_two_status_fields_deterministic(spark):
    a = [(1, "verification_status", "ProjectMedia", 7, "User", 3, None, None, "2020-01-01")]
    f = [(10, 1, "verification_status", "verification_status_status", "select", '"a"', None),
         (11, 1, "verification_status", "verification_status_status", "select", '"b"', None)]
    ws = _ws(spark, annotations=a, dynamic_annotation_fields=f, users=[(3, "smooch")])
    last = I.last_statuses(ws).first()
    assert (last.status, last.login) == ("b", "smooch")      # higher field id wins
    rows = {r.value: r.rn_desc for r in I.statuses(ws).collect()}
    assert rows == {'"b"': 1, '"a"': 2}
    facts = I.item_annotation_facts(ws).first()
    assert facts.status == "b"


def test_items_edge_workspace(spark):
    pm = [(7, "2020-01-02 03:04:05", 3, 1, 1, 99, 0)]
    ws = _ws(spark, project_medias=pm, medias=[(1, "Claim", "u")],
             teams=[(1, "t", "statuses: none\n")], users=[(3, "smooch")],
             annotations=[(1, "verification_status", "ProjectMedia", 7, "User", 3, None, None, "x")],
             dynamic_annotation_fields=[(10, 1, "verification_status", "verification_status_status",
                                         "select", '"verified"', None)])
    row = I.items(ws).first()
    assert (row.item_id, row.item_status, row.item_status_by, row.media_type, row.folder) == \
        (7, "verified", None, "Text", None)


def test_titles_and_contents_of_the_latest_status(spark):
    a = [(i, kind, "ProjectMedia", item, "User", 3, None, None, "x") for i, kind, item in
         [(1, "verification_status", 7), (2, "verification_status", 7), (3, "language", 8), (4, "verification_status", 9)]]
    status = "verification_status_status"
    f = [(10 * i + k, i, "verification_status", name, "text", value, None) for i, k, name, value in
         [(1, 0, status, '"a"'), (1, 1, "title", '"old"'), (2, 0, status, '"b"'), (2, 1, "title", '"t1"'), (2, 2, "title", None),
          (2, 3, "content", '"c1"'), (2, 4, "content", '"c2"'), (4, 1, "title", '"no status"')]]
    f.append((30, 3, "language", "language", "language", '"en"', None))
    ws = _ws(spark, annotations=a, dynamic_annotation_fields=f)
    facts = I.item_annotation_facts(ws)
    assert "titles" not in facts.columns    # no list of an annotation's texts in one row
    rows = I._with_status_texts(facts, ws).collect()
    key = lambda r: (r.project_media_id, r.status or "", r.title or "", r.content or "", r.language or "")
    assert sorted(map(key, rows)) == [(7, "b", "", "c1", ""), (7, "b", "", "c2", ""), (7, "b", "t1", "c1", ""), (7, "b", "t1", "c2", ""),
                                      (8, "", "", "", "en"), (9, "", "", "", "")]
