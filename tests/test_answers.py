"""Golden vectors for answer formatting (one DataFrame row per case)."""

import json

import pytest

from verilens.functions.answers import with_answer

BASE = "https://assets.test/uploads/dynamic/"


def geo(coordinates, properties="{}"):
    text = '{"type":"Feature","geometry":{"type":"Point","coordinates":%s},"properties":%s}' % (coordinates, properties)
    return json.dumps(text), text


SINGLE, MULTI = "task_response_single_choice", "task_response_multiple_choice"
NOT_POINTS = [geo(c) for c in ('"1.5,2.5"', '{"lat":1}', "[]", "[1.5,2.5,3.5]", "null", '["a","b"]')]

# (annotation_type, field_type, value, file, expected)
CASES = [
    # decoded once, or raw if that fails
    *[("any", t, json.dumps(v), "", v) for t in ("id", "image_path", "json", "language", "text") for v in ("", 'a "b"\n\\c', "pt_BR")],
    *[("any", t, v, "", v) for t in ("text", "language", "boolean", "unknown") for v in ("{broken", '"open')],
    # choices
    (SINGLE, "select", '"second option"', "", "second option"),
    (SINGLE, "select", json.dumps('{"selected":["x"]}'), "", '{"selected":["x"]}'),
    (MULTI, "select", json.dumps('{"selected":["x","y, z"],"other":"w"}'), "", "x, y, z, Other (w)"),
    (MULTI, "select", json.dumps('{"other":null,"selected":["only"]}'), "", "only"),
    (MULTI, "select", json.dumps('{"selected":[]}'), "", ""),
    (MULTI, "select", "]", "", "]"),
    # files
    ("any", "image", '"caption"', '["scan 7.jpg","b.jpg"]', BASE + "123/scan%207.jpg"),
    ("any", "image", '"caption"', None, "caption"),
    # places: a point of two numbers inside a JSON string, else the decoded text
    ("any", "geojson", geo("[-1.25,40.0]", '{"name":"Lake, north shore"}')[0], "", "Lake, north shore (-1.25, 40.0)"),
    ("any", "geojson", geo("[-1.25,40.0]", '{"name":7}')[0], "", "(-1.25, 40.0)"),
    *[("any", "geojson", v, "", text) for v, text in NOT_POINTS],
    # times
    ("any", "datetime", '"2021-06-30 23:59 -2 BRST "', "", "2021-07-01T01:59Z"),
    ("any", "datetime", '"2021-06-30 9:5 +1 CET notime"', "", "2021-06-30"),
    ("any", "datetime", '"June 2021"', "", '"June 2021"'),
    # edge rows (decisions D9-D11, V5, V6)
    ("any", "text", "true", "", "True"),
    ("any", "text", "null", "", "None"),
    ("any", "text", "12", "", "12"),
    ("task_response_multiple_choice", "select",
     r'"{\"selected\":[\"a\"],\"other\":\"\"}"', "", "a, Other ()"),
    ("any", "image", '"x"', '["a b*~/é.png"]', BASE + "123/a%20b%2A~/%C3%A9.png"),
    ("any", "image", '"x"', "[]", '"x"'),
    ("any", "image", '"x"', "not json", '"x"'),
    ("any", "datetime", '"2020-13-01 1:00 0 GMT "', "", '"2020-13-01 1:00 0 GMT "'),
    ("any", "geojson", "not json", "", "not json"),
    # objects and arrays as they are written, without the blanks between their tokens
    ("any", "text", '{"type": "text",\n "aa":1.50 }', "", '{"type":"text","aa":1.50}'),
    ("any", "json", '[ 1e3, {"z" : "a  \\\\\\"  b", "a": -0.0} , 12345678901234567890123 ]', "", '[1e3,{"z":"a  \\\\\\"  b","a":-0.0},12345678901234567890123]'),
    ("any", "id", '{"k": "%s  \\\\"}' % ("x \\n" * 40_000), "", '{"k":"%s  \\\\"}' % ("x \\n" * 40_000)),
    (MULTI, "select", json.dumps('[ {"b": 2.0, "a": 1} ]'), "", '[{"b":2.0,"a":1}]'),
    (SINGLE, "select", '{"b": [ ], "a": {}}', "", '{"b":[],"a":{}}'),
    ("any", "geojson", '{"b": 1.0, "a" : 2}', "", '{"b":1.0,"a":2}'),
    ("any", "text", None, "", None),
]


@pytest.fixture(scope="module")
def formatted(spark):
    rows = [(i, 123, a, f, v, fl) for i, (a, f, v, fl, _) in enumerate(CASES)]
    df = spark.createDataFrame(
        rows, "i int, annotation_id long, annotation_type string, field_type string, "
              "value string, file string")
    out = with_answer(df, "answer", "annotation_id", "annotation_type", "field_type", "value", "file",
                      asset_base_url=BASE)
    return {r.i: r.answer for r in out.select("i", "answer").collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_golden(formatted, i):
    assert formatted[i] == CASES[i][4], CASES[i]
