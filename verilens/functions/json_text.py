"""JSON held in text columns, decoded with native expressions (stay in codegen).

Semantics follow the report SQL's JSON functions:

* a JSON ``null`` decodes to SQL NULL (``get_json_object(x, '$')`` would give
  the text ``null``, so the root is decoded through a variant instead);
* malformed JSON decodes to NULL (the report SQL would fail as a whole);
* strings come back unquoted, numbers as their text, objects/arrays minified.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant(c: Column) -> Column:
    """``try_parse_json``: a variant, NULL when the text is not JSON."""
    return F.try_parse_json(c)


def variant_type(v: Column) -> Column:
    """Type name of a variant: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN,
    VOID (JSON null), OBJECT<..>, ARRAY<..>; NULL for a NULL variant."""
    return F.schema_of_variant(v)


def variant_text(v: Column, path: str = "$") -> Column:
    return F.variant_get(v, path, "string")


def json_scalar(c: Column) -> Column:
    """Decode a JSON document at its root (``json_extract(x, '$')``); true and false are 1 and 0."""
    text = variant_text(variant(c))
    root = F.trim(c, F.lit(" \t\r\n"))
    return F.when(root == "true", F.lit("1")).when(root == "false", F.lit("0")).otherwise(text)


def json_path(c: Column, path: str) -> Column:
    """Value at ``$.a.b`` / ``$.a[0].b`` (``json_extract(x, path)``); JSON null,
    a missing path or malformed text give NULL."""
    return F.get_json_object(c, path)


_JAVA_SCI = r"^(-?)(\d)(?:\.(\d+))?E(-?\d+)$"


def _bind(c: Column, body) -> Column:
    """``body(x)`` with ``x`` bound once to ``c`` (a lambda variable), so a
    value used many times in ``body`` is neither copied into the expression
    tree nor computed again."""
    return F.transform(F.array(c), body).getItem(0)


def _shortest_digits(x: Column) -> Column:
    """The JVM's ``Double.toString`` (before Java 19) sometimes prints more
    significant digits than needed.  When it printed 16 or more, the
    shortest correctly rounded form that reads back as the same double is
    searched (fewest digits first), which is what the shortest round-trip
    repr is; it is written like Java's scientific form for the formatter
    below.  Short outputs (the usual case) skip the search."""
    mantissa = F.regexp_replace(x, "E.*$", "")
    significant = F.length(F.regexp_replace(F.regexp_replace(mantissa, "[^0-9]", ""), "^0+", ""))
    # also subnormals (exponent -300 and below), whose digits the JVM pads
    needs_search = x.rlike(r"[.E]") & ((significant >= 16) | x.rlike(r"E-3\d\d$"))

    def search(d: Column) -> Column:
        forms = [F.format_string(f"%.{p - 1}e", d) for p in range(1, 18)]
        return F.coalesce(*[F.when(f.try_cast("double") == d, f) for f in forms])

    def java_like(candidate: Column) -> Column:
        return F.when(candidate.isNull(), x).otherwise(F.concat(
            F.regexp_extract(candidate, r"^(-?\d(?:\.\d+)?)e", 1), F.lit("E"),
            F.regexp_extract(candidate, r"e([-+]\d+)$", 1).cast("int").cast("string")))

    found = _bind(x.try_cast("double"), lambda d: _bind(search(d), java_like))
    return F.when(needs_search, found).otherwise(x)


def _python_layout(c: Column) -> Column:
    def g(i):
        return F.regexp_extract(c, _JAVA_SCI, i)
    sign, d0, rest, e = g(1), g(2), F.rtrim(g(3), F.lit("0")), g(4).cast("int")
    digits = F.concat(d0, rest)
    int_part = F.substring(F.rpad(digits, F.greatest(e + 1, F.lit(1)), "0"), 1, e + 1)
    frac = F.when(F.length(digits) > e + 1, digits.substr(e + 2, F.length(digits))).otherwise(F.lit("0"))
    fixed = F.when(e >= 0, F.concat(sign, int_part, F.lit("."), frac)).otherwise(
        F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits))
    sci = F.concat(sign, d0, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(F.lit("")),
                   F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.abs(e) < 10, F.concat(F.lit("0"), F.abs(e).cast("string")))
                   .otherwise(F.abs(e).cast("string")))
    return F.when(~c.rlike(_JAVA_SCI), c).when((e >= -4) & (e < 16), fixed).otherwise(sci)


def python_number(c: Column) -> Column:
    """A JSON number's text as ``str(json.loads(...))`` prints it.

    ``c`` comes from ``get_json_object``, which keeps integers as written and
    prints other numbers as the shortest round-trip decimal, in scientific
    form outside [1e-3, 1e7).  Python uses the same digits but switches to
    scientific form outside [1e-4, 1e16) and writes ``1e-07`` for ``1.0E-7``;
    only that form is rewritten.  Exact for |x| < 1e17 (checked on random
    doubles against ``json``); above that a JVM older than 19 may print a
    different last digit."""
    return _bind(c, lambda x: _bind(_shortest_digits(x), _python_layout))


def minified(text: Column) -> Column:
    """A JSON document without the blanks between its tokens; keys keep their
    order, numbers their digits and strings their spelling.

    The pattern's repetitions are possessive, so a long string costs no stack."""
    return F.regexp_replace(text, r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|[ \t\r\n]++', "$1")


def python_text(v: Column, text: Column | None = None) -> Column:
    """How a decoded JSON value prints in Python (``str(json.loads(x))``) for
    scalars: strings as is, ``True``/``False``/``None``, numbers as Python
    prints them (when the JSON ``text`` is given).  Objects and arrays print
    as minified JSON (documented deviation), as the ``text`` writes them."""
    t = variant_type(v)
    number = (python_number(F.get_json_object(text, "$")) if text is not None
              else variant_text(v))
    nested = F.lit(False) if text is None else t.rlike(r"^(OBJECT|ARRAY)")
    return (F.when(nested, minified(text) if text is not None else F.lit(None))
            .when(t == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), F.lit("True"))
                  .otherwise(F.lit("False")))
            .when(t == "VOID", F.lit("None"))
            .when(t.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*|DOUBLE|FLOAT)$"), number)
            .otherwise(variant_text(v)))


def is_malformed(c: Column) -> Column:
    """True for a non-NULL text that is not a JSON document (those decode to
    NULL; counting them keeps the deviation visible)."""
    return c.isNotNull() & F.try_parse_json(c).isNull()
