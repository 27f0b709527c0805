"""Human-readable task answers from annotation field values (native, no UDF).

``with_answer`` dispatches on ``field_type``:

* text, language, json, image_path, id: the value is a JSON-encoded string;
  decode once (not JSON: the raw value);
* image: with an annotation file -> asset URL built from the first file name;
  without one -> the decoded value;
* select: decode once; multiple-choice answers are JSON inside JSON: decode
  again and print ``a, b, Other (x)``;
* geojson: JSON inside JSON; a two-number Point Feature prints as
  ``name (lat, lng)`` or ``(lat, lng)``, anything else as the once-decoded text;
* datetime: ``"YYYY-MM-DD h:m ±off TZ [notime]"`` -> ``YYYY-MM-DD`` or the UTC
  minute ``YYYY-MM-DDTHH:MMZ``; no match -> the raw value;
* anything else: the raw value.

Where the original per-row formatter would raise (and lose the whole
report), the raw value is returned instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verilens.functions.json_text import python_number, python_text, variant, variant_text, variant_type
from verilens.functions.strings import path_quote

# Fixed values.
JSON_STRING_FIELD_TYPES = ["text", "language", "json", "image_path", "id"]
MULTIPLE_CHOICE = "task_response_multiple_choice"
DATETIME_PATTERN = (r'(?d)^"(\d{4})-(\d\d)-(\d\d) (\d\d?):(\d\d?) ([-+]?\d\d?) '
                    r'[A-Za-z0-9_]+ (notime)?"$')
DEFAULT_ASSET_BASE_URL = "https://assets.example.org/uploads/dynamic/"

_NUMBER = r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)$"


def _sub(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "variant")


def _type_at(v: Column, path: str) -> Column:
    return variant_type(_sub(v, path))


def value_source(value: Column, value_json: Column) -> Column:
    """An empty ``value`` means the answer is in ``value_json``."""
    return F.when(value == "", value_json).otherwise(value)


def _image(annotation_id: Column, value: Column, file: Column, base_url: str) -> Column:
    v = variant(value)
    t = variant_type(v)
    decoded = (F.when(t == "STRING", variant_text(v))
               .when(t.rlike(_NUMBER), variant_text(v))
               .when(t == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), F.lit("1"))
                     .otherwise(F.lit("0")))
               .when(t == "VOID", F.lit(None).cast("string"))
               .otherwise(value))
    f = variant(file)
    ft = variant_type(f)
    first = (F.when(ft.startswith("ARRAY") & (_type_at(f, "$[0]") == "STRING"),
                    F.variant_get(f, "$[0]", "string"))
             .when((ft == "STRING") & (F.length(variant_text(f)) > 0),
                   F.substring(variant_text(f), 1, 1)))
    url = F.concat(F.lit(base_url), annotation_id.cast("string"), F.lit("/"), path_quote(first))
    no_file = F.when(v.isNull(), value).otherwise(decoded)
    return (F.when(file.isNull(), no_file)
            .when(first.isNotNull(), url)
            .otherwise(value))


def _datetime(value: Column) -> Column:
    def g(i: int) -> Column:
        return F.regexp_extract(value, DATETIME_PATTERN, i)

    matched = value.rlike(DATETIME_PATTERN)
    date_only = F.concat_ws("-", g(1), g(2), g(3))
    local = F.try_make_timestamp_ntz(g(1).cast("int"), g(2).cast("int"), g(3).cast("int"),
                                     g(4).cast("int"), g(5).cast("int"), F.lit(0))
    utc = local - F.make_dt_interval(F.lit(0), g(6).cast("int"))
    minute = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm"), F.lit("Z"))
    valid = local.isNotNull() & (g(1).cast("int") > 0)
    return (F.when(~matched, value)
            .when(g(7) == "notime", date_only)
            .when(valid & (F.year(utc) >= 1), minute)
            .otherwise(value))


def with_answer(df, out: str, annotation_id: str, annotation_type: str, field_type: str,
                value: str, annotation_file: str,
                asset_base_url: str = DEFAULT_ASSET_BASE_URL):
    """``df`` with the formatted answer; parses each value's JSON once.

    The first projection parses the value (and, for the double-encoded
    field types, the once-decoded text) into variant columns, and the answer
    reads those.  Spark keeps the parse in its own projection because the
    result is used several times."""
    ft, at = F.col(field_type), F.col(annotation_type)
    v1 = variant(F.col(value))
    staged = df.withColumn("__v1", v1)
    once = python_text(F.col("__v1"), F.col(value))
    needs_second = ft.isin("geojson") | ((ft == "select") & (at == MULTIPLE_CHOICE))
    staged = staged.withColumn("__once", F.when(F.col("__v1").isNotNull(), once)) \
        .withColumn("__v2", F.when(needs_second, variant(F.col("__once"))))
    answer = _answer_from_variants(F.col(annotation_id), at, ft, F.col(value), F.col(annotation_file),
                                   F.col("__v1"), F.col("__once"), F.col("__v2"), asset_base_url)
    return staged.withColumn(out, answer).drop("__v1", "__once", "__v2")


def _answer_from_variants(annotation_id, annotation_type, field_type, value, file, v, once, v2,
                          base_url):
    t = variant_type(v)
    # JSON-string types and single choice: the once-decoded text
    json_string = F.when(v.isNull(), value).otherwise(once)
    # multiple choice
    sel_t = _type_at(v2, "$.selected")
    selected = F.try_variant_get(v2, "$.selected", "array<string>")
    all_strings = (variant_type(v2).startswith("OBJECT")
                   & ((sel_t == "ARRAY<STRING>") | (sel_t.startswith("ARRAY") & (F.size(selected) == 0)))
                   & ~F.exists(selected, lambda x: x.isNull()))
    other = F.when(_type_at(v2, "$.other") == "STRING",
                   F.array(F.concat(F.lit("Other ("), F.variant_get(v2, "$.other", "string"), F.lit(")"))))
    choices = F.array_join(F.concat(selected, F.coalesce(other, F.array().cast("array<string>"))), ", ")
    multi = F.when(v2.isNull(), once).when(all_strings, choices).otherwise(python_text(v2, once))
    select = (F.when(v.isNull(), value)
              .when((t == "STRING") & (annotation_type == MULTIPLE_CHOICE), multi)
              .otherwise(once))
    # geojson
    # a point only inside a JSON string; other JSON prints as it was decoded
    coordinates = F.when(_type_at(v2, "$.geometry.coordinates").startswith("ARRAY"),
                         F.try_variant_get(v2, "$.geometry.coordinates", "array<variant>"))
    n_coords = F.coalesce(F.size(coordinates), F.lit(-1))
    is_point = ((t == "STRING") & variant_type(v2).startswith("OBJECT")
                & (F.variant_get(v2, "$.type", "string") == "Feature")
                & (_type_at(v2, "$.type") == "STRING")
                & _type_at(v2, "$.geometry").startswith("OBJECT")
                & (_type_at(v2, "$.geometry.type") == "STRING")
                & (F.variant_get(v2, "$.geometry.type", "string") == "Point")
                & (n_coords == 2)
                & _type_at(v2, "$.geometry.coordinates[0]").rlike(_NUMBER)
                & _type_at(v2, "$.geometry.coordinates[1]").rlike(_NUMBER))
    pair = F.concat(F.lit("("), python_number(F.get_json_object(once, "$.geometry.coordinates[0]")),
                    F.lit(", "), python_number(F.get_json_object(once, "$.geometry.coordinates[1]")),
                    F.lit(")"))
    named = (_type_at(v2, "$.properties").startswith("OBJECT")
             & (_type_at(v2, "$.properties.name") == "STRING"))
    point = F.when(named, F.concat(F.variant_get(v2, "$.properties.name", "string"), F.lit(" "), pair)
                   ).otherwise(pair)
    geo = F.when(v.isNull(), value).when(is_point, point).otherwise(once)
    return (F.when(value.isNull(), F.lit(None).cast("string"))
            .when(field_type.isin(JSON_STRING_FIELD_TYPES), json_string)
            .when(field_type == "image", _image(annotation_id, value, file, base_url))
            .when(field_type == "select", select)
            .when(field_type == "geojson", geo)
            .when(field_type == "datetime", _datetime(value))
            .otherwise(value))
