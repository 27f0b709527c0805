"""Values read out of YAML text columns.

Most rows hold one-line scalars (``label: Question 3``, ``text: note 12``);
those are read with a regular expression inside codegen.  Rows the expression
cannot read faithfully (quoted scalars with escapes, block or multi-line
scalars, comments, flow collections, YAML-typed plain scalars) are marked
"not simple" and only they are sent, in Arrow batches, to a pandas UDF that
uses a real YAML parser.  Simple rows pass a NULL to the UDF, so the Python
side does almost no work for them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# First character of a plain scalar: no indicator.
_PLAIN_START = r"^[^\s\-?:,\[\]{}#&*!|>'\"%@`]"
# YAML 1.1 plain scalars that a loader would turn into non-strings.
_TYPED = (r"(?i)^(?:~|null|y|yes|n|no|true|false|on|off|[-+]?(?:0|[1-9][0-9_]*)|"
          r"[-+]?0[0-7_]+|[-+]?0x[0-9a-f_]+|[-+]?0b[01_]+|[-+]?[0-9][0-9_:]*|"
          r"[-+]?(?:[0-9][0-9_]*)?\.[0-9_]*(?:e[-+][0-9]+)?|[-+]?\.(?:inf)|\.nan|"
          r"\d{4}-\d{1,2}-\d{1,2}.*|=|<<)$")


def _key_line(key: str) -> str:
    # the first top-level line for ``key``: at column 0, then the value
    return rf"(?m)^{key}:(?:[ \t]+(.*?))?[ \t]*$"


def _is_plain(raw: Column) -> Column:
    """A plain scalar that may be taken verbatim.

    Said by what it must not have (``: ``, `` #``, a colon at the end): a
    pattern that repeats a group is matched recursively, one frame for each
    character, and a long text would overflow the stack."""
    return raw.rlike(_PLAIN_START) & ~raw.rlike(r":[ \t]|[ \t]#|:$")


def _native_scalar(c: Column, key: str, allow_typed: bool,
                   single_key: bool = False) -> tuple[Column, Column]:
    """(value, simple) for the first top-level ``key:`` line of ``c``.

    ``single_key``: the caller reads the document as a mapping, where a later
    duplicate key wins, so a document with several ``key:`` lines is not
    simple."""
    pattern = _key_line(key)
    raw = F.regexp_extract(c, pattern, 1)
    has_key = c.rlike(pattern)
    # the line after the key line must start a new key (column 0) or end text
    after = F.regexp_extract(c, rf"(?ms)^{key}:[^\n]*\n(.?)", 1)
    next_ok = ~after.rlike(r"^[ \t]")
    plain = _is_plain(raw) & (allow_typed | ~raw.rlike(_TYPED))
    inner = raw.substr(F.lit(2), F.length(raw) - 2)
    long = F.length(raw) >= 2
    single = (long & raw.startswith("'") & raw.endswith("'")
              & ~F.replace(inner, F.lit("''"), F.lit("")).contains("'"))
    double = long & raw.startswith('"') & raw.endswith('"') & ~inner.rlike(r'["\\]')
    value = (F.when(plain, raw)
             .when(single, F.replace(inner, F.lit("''"), F.lit("'")))
             .when(double, inner))
    # a line before the key line that starts a flow collection, a quoted or a
    # complex key could hide an earlier top-level key: not simple
    risky_prefix = F.split(c, rf"(?m)^{key}:", 2)[0].rlike(r"(?m)^[\[{'\"?]")
    simple = has_key & next_ok & (plain | single | double) & ~risky_prefix
    if single_key:
        simple = simple & (F.regexp_count(c, F.lit(rf"(?m)^{key}:")) == 1)
    return value, simple


def _no_key(c: Column, key: str) -> Column:
    """True when no line could hold the key at all (the answer is NULL)."""
    return ~c.contains(key)


# ---------------------------------------------------------------- Python side


def _yaml_module():
    import yaml  # PyYAML; only imported on executors that meet a hard row
    return yaml


def _compose_readable_prefix(yaml, text: str):
    """Compose the document; when it is invalid, compose the lines before the
    reported error instead (a key read before the error still counts)."""
    while text:
        try:
            return yaml.compose(text, Loader=yaml.SafeLoader)
        except yaml.MarkedYAMLError as e:
            mark = e.problem_mark or e.context_mark
            lines = text.split("\n")
            if mark is None or mark.line >= len(lines) or mark.line == 0:
                return None
            text = "\n".join(lines[:mark.line])
        except yaml.YAMLError:
            return None
    return None


def _first_top_level_scalar(text: str, key: str):
    """Raw scalar text of the first top-level ``key`` whose value is a
    non-empty scalar; NULL when there is none.  For an invalid document only
    the part before the error is read."""
    yaml = _yaml_module()
    root = _compose_readable_prefix(yaml, text)
    if not isinstance(root, yaml.MappingNode):
        return None
    for k, v in root.value:
        if isinstance(k, yaml.ScalarNode) and k.value == key and isinstance(v, yaml.ScalarNode):
            if v.value == "" and v.style is None:   # "key:" with nothing after it
                continue
            return v.value
    return None


def _loaded_text(text: str, key: str):
    """``str`` of ``safe_load(text)[key]`` as SQL would store it (booleans as
    1/0, None as NULL); NULL when the text is not a mapping with that key."""
    yaml = _yaml_module()
    try:
        doc = yaml.safe_load(text)
        value = doc[key]
    except Exception:  # noqa: BLE001 - any unreadable comment gives NULL
        return None
    if value is None:
        return None
    if isinstance(value, bool):
        return "1" if value else "0"
    if hasattr(value, "isoformat"):
        return value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    if isinstance(value, (str, int, float)):
        return str(value)
    return None


@F.pandas_udf(T.StringType())
def _label_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _first_top_level_scalar(t, "label"))


@F.pandas_udf(T.StringType())
def _comment_text_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _loaded_text(t, "text"))


# ------------------------------------------------------------------ operators


def task_label(data: Column) -> Column:
    """First top-level scalar ``label`` of a task's YAML (raw scalar text)."""
    value, simple = _native_scalar(data, "label", allow_typed=True)
    hard = data.isNotNull() & ~simple & ~_no_key(data, "label")
    return F.when(simple, value).when(hard, _label_udf(F.when(hard, data)))


def comment_text(comment_yaml: Column) -> Column:
    """``text`` of a comment's YAML mapping, as text."""
    value, simple = _native_scalar(comment_yaml, "text", allow_typed=False, single_key=True)
    hard = comment_yaml.isNotNull() & ~simple & ~_no_key(comment_yaml, "text")
    return F.when(simple, value).when(hard, _comment_text_udf(F.when(hard, comment_yaml)))


def with_unreadable_comment(df, col: str, out: str):
    """``df`` plus ``out``: true where the comment text is NULL although the document names one."""
    named = F.coalesce(F.col(col).rlike(r"(?m)^text:[ \t]*[^ \t\n~]"), F.lit(False))
    return with_comment_text(df, col, "__text").withColumn(out, F.col("__text").isNull() & named).drop("__text")


def unreadable_comments(df, col: str):
    """Rows of ``df`` whose comment text is NULL although the document names one."""
    return with_unreadable_comment(df, col, "__unreadable").filter("__unreadable").drop("__unreadable")


# ----------------------------------------------------- DataFrame operators


def _with_scalar(df, col: str, out: str, key: str, allow_typed: bool, udf, single_key=False):
    """One pass: what the expression reads faithfully stays native; the parser gets
    the texts of the other rows, and NULL for a row that it has nothing to do for."""
    c = F.col(col)
    value, simple = _native_scalar(c, key, allow_typed, single_key)
    read = df.withColumn("__y", F.struct(value.alias("value"), simple.alias("simple")))
    hard = c.isNotNull() & ~F.coalesce("__y.simple", F.lit(False)) & ~_no_key(c, key)
    return read.withColumn("__parsed", udf(F.when(hard, c))).withColumn(
        out, F.when(F.col("__y.simple"), F.col("__y.value")).otherwise(F.col("__parsed"))).drop("__y", "__parsed")


def with_task_label(df, col: str, out: str):
    """``df`` plus ``out`` = first top-level scalar ``label`` of ``col``."""
    return _with_scalar(df, col, out, "label", True, _label_udf)


def with_comment_text(df, col: str, out: str):
    """``df`` plus ``out`` = the ``text`` value of the comment YAML in ``col``."""
    return _with_scalar(df, col, out, "text", False, _comment_text_udf, single_key=True)
