"""Task labels and comment texts out of YAML text (golden vectors + edges)."""

import pytest
from pyspark.sql import functions as F

from verilens.functions.yaml_text import comment_text, task_label, with_comment_text, with_task_label

H = "--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess\n"

LABELS = [
    ("title: no label here\nlabels: [x]\n", None),
    (H + "slug: where\nlabel: Where was it filmed?\ntype: geolocation\n", "Where was it filmed?"),
    (H + "label: \"a, b\"\nrequired: true\n", "a, b"),
    (H + "options:\n- label: inner\n  value: 1\nextra:\n  label: deeper\nlabel: Outer\n", "Outer"),
    ("label: see https://example.org/a:b#c\n", "see https://example.org/a:b#c"),
    ("label: 1:30:00\n", "1:30:00"),
    # edges: quoting, typed scalars stay raw text, block scalar, comment, empty
    ("label: 'it''s'\n", "it's"),
    ('label: "tab\\there"\n', "tab\there"),
    ("label: 12\n", "12"),
    ("label: true\n", "true"),
    ("label: |\n  two\n  lines\n", "two\nlines\n"),
    ("label: plain # comment\n", "plain"),
    ("label: multi\n  line\n", "multi line"),
    ("label:\nother: x\n", None),
    ("label: [a, b]\nlabel: later\n", "later"),
    ("not: [valid\n", None),
    ("label: before\nbad: [x\nlabel: after\n", "before"),
    ("label: " + "Q " * 60_000 + "end\n", "Q " * 60_000 + "end"),
    ("label: '" + "''q" * 50_000 + "'\n", "'q" * 50_000),
    ('label: "' + "z" * 100_000 + '"\n', "z" * 100_000),
    (None, None),
]

COMMENTS = [
    ("text: note 12\n", "note 12"),
    ("text: 'quoted ''x'''\n", "quoted 'x'"),
    ("text: |\n  block\n  text\n", "block\ntext\n"),
    ("text: 12\n", "12"),
    ("text: "+ "ab c:d " * 20_000 + "end\n", "ab c:d " * 20_000 + "end"),
    ("text: '" + "it''s " * 20_000 + "'\n", "it's " * 20_000),
    ('text: "' + "x y " * 30_000 + '"\n', "x y " * 30_000),
    ("text: " + "1:" * 60_000 + "x\n", "1:" * 60_000 + "x"),
    ("note: " + "n" * 100_000 + "\ntext: short\n", "short"),
    ("text: |\n  " + "b" * 100_000 + "\n", "b" * 100_000 + "\n"),
    ("text: true\n", "1"),
    ("text: ~\n", None),
    ("other: 1\n", None),
    ("text: [unclosed\n", None),
]


def _run(spark, fn, cases):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    return {r.i: r.v for r in df.select("i", fn(F.col("t")).alias("v")).collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return _run(spark, task_label, LABELS)


@pytest.fixture(scope="module")
def comments(spark):
    return _run(spark, comment_text, COMMENTS)


@pytest.mark.parametrize("i", range(len(LABELS)))
def test_label(labels, i):
    assert labels[i] == LABELS[i][1], LABELS[i]


@pytest.mark.parametrize("i", range(len(COMMENTS)))
def test_comment(comments, i):
    assert comments[i] == COMMENTS[i][1], COMMENTS[i]


@pytest.mark.parametrize("cases,op", [(LABELS, with_task_label), (COMMENTS, with_comment_text)])
def test_split_operator(spark, cases, op):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r.v for r in op(df, "t", "v").collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def _random_doc(rnd, key):
    words = ["note", "two words", "a: b", "x #y", "it's", "#tag", "true", "12", "1.5", "~", "null",
             "yes", "-dash", "[a, b]", "{a: 1}", "'quoted'", "'it''s'", '"dq"', '"tab\\tx"', "é ü",
             "2020-01-02", "a:b", "a #b", "", "*ref", "&anchor x", "!tag x", "| ", "> "]
    lines = []
    if rnd.random() < 0.5:
        lines.append("--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess")
    for _ in range(rnd.randint(1, 5)):
        k = rnd.choice([key, key, "other", "type", f"{key}2", "options"])
        v = rnd.choice(words)
        lines.append(f"{k}: {v}".rstrip() if v else f"{k}:")
        r = rnd.random()
        if r < 0.15:
            lines.append(f"  {rnd.choice(words)}")          # continuation / nested line
        elif r < 0.25:
            lines.append(f"- {key}: {rnd.choice(words)}")  # sequence at column 0
    return "\n".join(lines) + rnd.choice(["\n", "", "\n\n"])


@pytest.mark.parametrize("key,op,python", [
    ("label", with_task_label, "_first_top_level_scalar"),
    ("text", with_comment_text, "_loaded_text"),
])
def test_split_matches_yaml_parser(spark, key, op, python):
    """Random YAML documents: the native reading and the parser agree."""
    import random

    import verilens.functions.yaml_text as Y

    import yaml

    def valid(d):
        try:
            yaml.safe_load(d)
            return True
        except yaml.YAMLError:
            return False

    rnd = random.Random(5)
    docs = [d for d in (_random_doc(rnd, key) for _ in range(1500)) if valid(d)][:600]
    assert len(docs) > 200
    df = spark.createDataFrame(list(enumerate(docs)), "i int, t string")
    got = {r.i: r.v for r in op(df, "t", "v").collect()}
    want = {i: getattr(Y, python)(d, key) for i, d in enumerate(docs)}
    bad = [(docs[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not bad, bad[:5]
