"""Output typing driven by column names.

Report SQL cannot state result types, so they follow from the names
(applied in this order):

1. a ``" [id|integer|text|dictionarytext|timestamp]"`` suffix names the type
   and is removed (the pattern has no end anchor: anything after it is
   dropped with it);
2. a name ending in ``_by`` -> dictionarytext (a login);
3. ``_id`` -> id;
4. ``_at`` -> timestamp (ISO-8601 text, anything else NULL);
5. otherwise text.

Spark types: id and integer -> bigint (the narrow int32 overflows at scale),
text and dictionarytext -> string, timestamp -> timestamp_ntz (UTC).  The
display hints go into column metadata (``format`` for numbers,
``dictionary`` for low-cardinality text; Parquet writers dictionary-encode
such columns on their own).  Empty and all-NULL columns are typed too, since
the type comes from the name, not the values.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verilens.functions.timestamps import with_iso_timestamps

# Fixed values.
SUFFIX = re.compile(r"(.+) \[(id|integer|text|dictionarytext|timestamp)\]")
METADATA = {
    "id": {"format": "{:d}"},
    "integer": {"format": "{:,d}"},
    "text": {},
    "dictionarytext": {"dictionary": True},
    "timestamp": {},
}


class OutputColumn(NamedTuple):
    name: str
    kind: str


def output_column(name: str) -> OutputColumn:
    m = SUFFIX.match(name)
    if m:
        return OutputColumn(m.group(1), m.group(2))
    if name.endswith("_by"):
        return OutputColumn(name, "dictionarytext")
    if name.endswith("_id"):
        return OutputColumn(name, "id")
    if name.endswith("_at"):
        return OutputColumn(name, "timestamp")
    return OutputColumn(name, "text")


def typed_column(c: Column, source_type: T.DataType, kind: str) -> Column:
    if kind in ("id", "integer"):
        if isinstance(source_type, T.StringType):
            return c.try_cast("bigint")
        return c.cast("bigint")
    if kind == "timestamp":
        return c.cast("timestamp_ntz")
    return c.cast("string")


def typed(df: DataFrame) -> DataFrame:
    """Rename and type every column by its name (text timestamps are parsed
    first, in their own projection)."""
    texts = {f.name: f.name for f in df.schema.fields
             if output_column(f.name).kind == "timestamp" and isinstance(f.dataType, T.StringType)}
    if texts:
        df = with_iso_timestamps(df, texts)
    cols = []
    for field in df.schema.fields:
        oc = output_column(field.name)
        c = typed_column(F.col(f"`{field.name}`"), field.dataType, oc.kind)
        cols.append(c.alias(oc.name, metadata=METADATA[oc.kind]))
    return df.select(cols)


def typed_empty(spark, names: list[str]) -> DataFrame:
    """A zero-row report with the types its column names imply."""
    kinds = {"id": T.LongType(), "integer": T.LongType(), "text": T.StringType(),
             "dictionarytext": T.StringType(), "timestamp": T.TimestampNTZType()}
    fields = []
    for n in names:
        oc = output_column(n)
        fields.append(T.StructField(oc.name, kinds[oc.kind], True, METADATA[oc.kind]))
    return spark.createDataFrame([], T.StructType(fields))
