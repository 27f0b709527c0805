"""Property tests: native expressions against independent public oracles on
random inputs (SQLite's own CAST/SUBSTR/INSTR/RTRIM through Python's sqlite3,
``urllib.parse.quote``, ``json.loads``).  Each example is a batch of values
evaluated in one DataFrame."""

import json
import re
import sqlite3
import urllib.parse

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verilens.functions.json_text import python_text, variant
from verilens.functions.strings import last_segment, path_quote, prefix_int, relationship_type, tag_id

TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"),
               max_size=30)   # SQLite string functions stop at NUL
NUMERIC_TEXT = st.one_of(
    TEXT,
    st.from_regex(r"\A[ \t\n]{0,3}[+-]?[0-9]{1,25}[a-z \n.]{0,4}\Z"),
    st.from_regex(r"\A[a-z]{0,3}tag: [0-9]{1,9}\n?\Z"),
)
SQLITE = sqlite3.connect(":memory:")


def _spark_values(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def _sqlite(sql, values):
    return [SQLITE.execute(sql, (v,)).fetchone()[0] for v in values]


@settings(max_examples=8, deadline=None)
@given(values=st.lists(NUMERIC_TEXT, min_size=1, max_size=60))
def test_prefix_int_is_sqlite_cast(spark, values):
    assert _spark_values(spark, values, prefix_int) == _sqlite("SELECT CAST(? AS INT)", values)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(NUMERIC_TEXT, min_size=1, max_size=60))
def test_tag_id_is_sqlite_arithmetic(spark, values):
    sql = "SELECT CAST(SUBSTR(?1, INSTR(?1, 'tag: ') + 5, LENGTH(?1) - 1) AS INT)"
    assert _spark_values(spark, values, tag_id) == _sqlite(sql, values)


REL = st.one_of(TEXT, st.builds(lambda a, b, n: f"---\n:source: {a}\n:target: {b}" + "\n" * n,
                                st.text("abc_", max_size=8), st.text("abc_ \n", max_size=8),
                                st.integers(0, 3)))


@settings(max_examples=8, deadline=None)
@given(values=st.lists(REL, min_size=1, max_size=60))
def test_relationship_type_is_sqlite(spark, values):
    sql = "SELECT RTRIM(SUBSTR(?1, INSTR(?1, ':target: ') + 9), CHAR(10))"
    assert _spark_values(spark, values, relationship_type) == _sqlite(sql, values)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(TEXT, min_size=1, max_size=60))
def test_path_quote_is_urllib(spark, values):
    assert _spark_values(spark, values, path_quote) == [urllib.parse.quote(v) for v in values]


SCALARS = st.one_of(TEXT, st.integers(-10**12, 10**12), st.booleans(), st.none(),
                    st.decimals(min_value=-10**6, max_value=10**6, places=3, allow_nan=False)
                    .map(lambda d: float(d)).filter(lambda f: "e" not in json.dumps(f)))


@settings(max_examples=8, deadline=None)
@given(values=st.lists(SCALARS.map(json.dumps), min_size=1, max_size=60))
def test_decoded_scalar_prints_like_python(spark, values):
    got = _spark_values(spark, values, lambda c: python_text(variant(c), c))
    assert got == [str(json.loads(v)) for v in values]


MESSAGES = st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12),
                    min_size=1, max_size=4).map(lambda ms: "\n⁣".join(ms))


@settings(max_examples=8, deadline=None)
@given(values=st.lists(MESSAGES, min_size=1, max_size=60))
def test_last_segment_is_last_message(spark, values):
    pattern = re.compile("(?:.*\n⁣)*(.*)", re.DOTALL)
    assert _spark_values(spark, values, last_segment) == [pattern.match(v).group(1) for v in values]


# Exact for |x| < 1e17; above, a JVM older than 19 may differ in the last digit.
FLOATS = st.one_of(
    st.floats(min_value=-1e17, max_value=1e17, allow_nan=False, exclude_min=True, exclude_max=True),
    st.floats(min_value=-1e-2, max_value=1e-2, allow_nan=False),
    st.floats(min_value=1e6, max_value=1e16, allow_nan=False),
    st.integers(-10**20, 10**20),
)


@settings(max_examples=25, deadline=None)
@given(values=st.lists(FLOATS.map(json.dumps), min_size=1, max_size=80))
def test_json_numbers_print_like_python(spark, values):
    from verilens.functions.json_text import python_number
    got = _spark_values(spark, values, lambda c: python_number(F.get_json_object(c, "$")))
    want = [str(json.loads(v)) for v in values]
    bad = [(v, g, w) for v, g, w in zip(values, got, want) if g != w]
    assert not bad, bad[:5]
