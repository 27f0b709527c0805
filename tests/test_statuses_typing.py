"""Status vocabulary (team settings YAML) and name-driven output typing."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from verilens.operators.statuses import label_statuses, status_vocabulary, unreadable_statuses
from verilens.operators.typing import output_column, typed, typed_empty

SYMBOLS = """--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess
:rules: []
:media_verification_statuses: !ruby/hash:ActiveSupport::HashWithIndifferentAccess
  :label: Status
  :statuses:
  - :id: verified
    :label: Verified
    :locales:
      :en:
        :label: nested, not this one
  - :label: 'It''s late'
    :id: late
:after: true
"""
STRINGS = """---
media_verification_statuses:
  default: false_claim
  statuses:
    - id: false_claim
      label: 'False'
    - id: "in progress"
      label: "In \\"progress\\""

    - id: odd
      label: [no, text]
    - id: false_claim
      label: Really false # the later one wins
other: !ruby/object:Set
  hash:
    ? a
    : true
"""
NESTED = """--- !ruby/hash-with-ivars:ActionController::Parameters
elements:
  media_verification_statuses:
    statuses:
    - id: a
      label: A
ivars:
  :@permitted: false
"""
WANT = {1: [("late", "It's late"), ("verified", "Verified")], 2: [("false_claim", "Really false"), ("in progress", 'In "progress"')], 3: [("a", "A")]}


def test_vocabularies_of_several_teams(spark):
    texts = [(1, SYMBOLS), (2, STRINGS), (3, NESTED), (4, "other: 1\n"), (5, "media_verification_statuses:\n  nothing: 1\n"), (6, "{ not yaml"), (7, None), (8, "")]
    teams = spark.createDataFrame(texts, "id long, settings string")
    got = {}
    for r in status_vocabulary(teams).collect():
        got.setdefault(r.team_id, []).append((r.status_id, r.status_label))
    assert {k: sorted(v) for k, v in got.items()} == WANT
    assert [(r.team_id, r.pos) for r in unreadable_statuses(teams).collect()] == [(2, 3)]


def test_labels_folded_over_lines_are_read_as_pyyaml_does(spark):
    yaml = pytest.importorskip("yaml")
    long = "word " * 40 + "end"
    labels = [long, long + " it's", 'say "' + long + '" \\ twice', "'" + long, long + ": x", "two\n\nlines " + long, "short", "# no comment " + long]
    dumped = yaml.safe_dump({"media_verification_statuses": {"statuses": [{"id": f"s{k}", "label": x} for k, x in enumerate(labels)]}}, sort_keys=False)
    own = """media_verification_statuses:
  statuses:
  -
    id: bare
    label: plain text

      after a blank line # comment
  - id: open
    label: "no end
  - id: noted
    label: 'quoted' # comment
"""
    flow = "media_verification_statuses:\n  statuses: [{id: a, label: b}]\n"
    mapping = "media_verification_statuses:\n  statuses:\n    a: b\n"
    teams = spark.createDataFrame([(1, dumped), (2, own), (3, flow), (4, mapping), (5, flow.replace("{id: a, label: b}", "")), (6, "media_verification_statuses:\n  statuses:\nafter: 1\n")],
                                  "id long, settings string")
    got = {(r.team_id, r.status_id): r.status_label for r in status_vocabulary(teams).collect()}
    assert got == {**{(1, f"s{k}"): x for k, x in enumerate(labels)}, (2, "bare"): "plain text\nafter a blank line", (2, "noted"): "quoted", (3, "a"): "b"}
    assert sorted((r.team_id, r.pos) for r in unreadable_statuses(teams).collect()) == [(2, 2), (4, 0)]


HASH, IVARS = "!ruby/hash:ActiveSupport::HashWithIndifferentAccess", "!ruby/hash-with-ivars:ActionController::Parameters"
WRITTEN = {
    "escapes": 'media_verification_statuses:\n  statuses:\n  - id: a\n    label: "\\u2705 Verified"\n  - id: b\n    label: "tab\\there \\x41\\U0001F600 \\"q\\" \\\\ \\/ \\_."\n'
               '  - id: c\n    label: "joined \\\n      line and\n      folded"\n  - id: "\\e"\n    label: x\n',
    "line ends": SYMBOLS.replace("\n", "\r\n"),
    "section in flow": "a: 1\nmedia_verification_statuses: {label: x, statuses: [{id: a, label: 'it''s, b'}, {label: \"c, [d]\", \"id\": e,\n  locales: {en: {label: no, id: no}}}]}\nb: 2\n",
    "entry with elements": f"---\n:media_verification_statuses: {HASH}\n  :statuses:\n  - {IVARS}\n    elements:\n      id: f\n      label: G h\n    ivars:\n      :@permitted: true\n"
                           f"  - {HASH}\n    :id: k\n    :label: L\n    :style:\n      :id: no\n",
    "elements everywhere": f"--- {IVARS}\nelements:\n  media_verification_statuses: {IVARS}\n    elements: {HASH}\n      statuses:\n      - id: a\n        label: A\n"
                           "    ivars: {}\nivars:\n  media_verification_statuses: no\n",
    "entry in flow": "media_verification_statuses:\n  statuses:\n  - {id: f, label: g}\n  - { ':id': h, ':label': \"\\u00e9t\\u00e9\" }\n  - id: i\n    label: j\n",
    "keys elsewhere": "x:\n  media_verification_statuses:\n    statuses:\n    - id: no\n      label: no\nmedia_verification_statuses:\n  other:\n    statuses:\n    - id: no\n      label: no\n"
                      "  # statuses: comment\n  statuses:\n# further left\n  - id: yes1\n    label: Yes it is # why\n",
    "whole text in flow": '{"other": [1, {"statuses": 2}], "media_verification_statuses": {"statuses": [{"id": "a", "label": "b: {c}"}]}}',
    "symbol first": "media_verification_statuses:\n  statuses: []\n  :statuses:\n  - id: no\n    :id: a\n    label: no\n    :label: b\n",
    "anchor": "media_verification_statuses: &x\n  statuses: &y\n  - &z\n    id: &i a\n    label: b\n",
}


def read_by_pyyaml(text):
    yaml = pytest.importorskip("yaml")

    class Loader(yaml.SafeLoader):
        pass

    Loader.add_constructor(HASH, lambda loader, node: loader.construct_mapping(node, deep=True))
    Loader.add_constructor(IVARS, lambda loader, node: loader.construct_mapping(node, deep=True)["elements"])

    def of(mapping, key):
        return mapping[":" + key] if ":" + key in mapping else mapping.get(key)
    found = of(of(yaml.load(text, Loader), "media_verification_statuses"), "statuses")
    return {of(x, "id"): of(x, "label") for x in found}


def test_written_forms_are_read_as_pyyaml_does(spark):
    teams = spark.createDataFrame(list(enumerate(WRITTEN.values())), "id long, settings string")
    got = {k: {} for k in range(len(WRITTEN))}
    for r in status_vocabulary(teams).collect():
        got[r.team_id][r.status_id] = r.status_label
    assert dict(zip(WRITTEN, got.values(), strict=True)) == {k: read_by_pyyaml(v) for k, v in WRITTEN.items()}
    assert unreadable_statuses(teams).count() == 0


def test_what_is_no_text_is_listed(spark):
    entries = ["id: ~\n    label: no id", "id: a\n    label: null", 'id: b\n    label: "\\q"', "id: c", "just text", "id: d\n    label: >\n      block", "id: e\n    label: fine"]
    text = "media_verification_statuses:\n  statuses:\n" + "".join(f"  - {e}\n" for e in entries)
    forms = [text, "media_verification_statuses: *other\n", "media_verification_statuses: 3\n", "media_verification_statuses:\n  statuses: text\n",
             f"media_verification_statuses: {IVARS}\n  ivars: 1\n", "media_verification_statuses: ~\n", "media_verification_statuses:\n  statuses: ~\n"]
    teams = spark.createDataFrame(list(enumerate(forms)), "id long, settings string")
    assert [tuple(r) for r in status_vocabulary(teams).collect()] == [(0, "e", "fine")]
    listed = unreadable_statuses(teams).collect()
    assert sorted((r.team_id, r.pos) for r in listed) == [(0, k) for k in range(1, 7)] + [(1, 0), (2, 0), (3, 0), (4, 0)]
    assert "*other" in [r.entry for r in listed]


def test_label_lookup(spark):
    teams = spark.createDataFrame([(1, SYMBOLS), (2, STRINGS)], "id long, settings string")
    rows = spark.createDataFrame([(1, "verified"), (1, "unknown"), (2, "false_claim"), (2, None),
                                  (3, "verified")], "team long, status string")
    got = sorted(map(tuple, label_statuses(rows, status_vocabulary(teams), "team", "status").collect()),
                 key=str)
    assert got == sorted([(1, "Verified"), (1, "unknown"), (2, "Really false"), (2, None), (3, "verified")],
                         key=str)


@pytest.mark.parametrize("name,want", [
    ("item_id", ("item_id", "id")), ("x_by", ("x_by", "dictionarytext")),
    ("made_at", ("made_at", "timestamp")), ("plain", ("plain", "text")),
    ("n [integer]", ("n", "integer")), ("folder [dictionarytext]", ("folder", "dictionarytext")),
    ("a [id] rest", ("a", "id")), ("when_at [text]", ("when_at", "text")),
])
def test_output_column(name, want):
    assert tuple(output_column(name)) == want


def test_typed(spark):
    df = spark.createDataFrame([(1, "2020-01-02 03:04:05", "7", "u", "x")],
                               "item_id int, created_at string, `n [integer]` string, owner_by string, note string")
    out = typed(df)
    assert [f.name for f in out.schema] == ["item_id", "created_at", "n", "owner_by", "note"]
    assert [type(f.dataType) for f in out.schema] == [T.LongType, T.TimestampNTZType, T.LongType,
                                                       T.StringType, T.StringType]
    assert out.schema["n"].metadata == {"format": "{:,d}"}
    assert out.first().created_at == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_typed_empty(spark):
    out = typed_empty(spark, ["item_id", "created_at", "x [integer]"])
    assert out.count() == 0 and [f.name for f in out.schema] == ["item_id", "created_at", "x"]
    assert [type(f.dataType) for f in out.schema] == [T.LongType, T.TimestampNTZType, T.LongType]
