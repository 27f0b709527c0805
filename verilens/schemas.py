"""Input schemas of the eleven workspace tables (types inferred from use)."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _I = T.LongType(), T.StringType(), T.IntegerType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, n != "id") for n, t in cols])


WORKSPACE_SCHEMAS: dict[str, T.StructType] = {
    "project_medias": _struct(("id", _L), ("created_at", _S), ("user_id", _L),
                              ("media_id", _L), ("team_id", _L),
                              ("project_id", _L), ("archived", _I)),
    "medias": _struct(("id", _L), ("type", _S), ("url", _S)),
    "teams": _struct(("id", _L), ("slug", _S), ("settings", _S)),
    "projects": _struct(("id", _L), ("title", _S)),
    "users": _struct(("id", _L), ("login", _S)),
    "annotations": _struct(("id", _L), ("annotation_type", _S),
                           ("annotated_type", _S), ("annotated_id", _L),
                           ("annotator_type", _S), ("annotator_id", _L),
                           ("data", _S), ("file", _S), ("created_at", _S)),
    "dynamic_annotation_fields": _struct(("id", _L), ("annotation_id", _L),
                                         ("annotation_type", _S),
                                         ("field_name", _S), ("field_type", _S),
                                         ("value", _S), ("value_json", _S)),
    "tag_texts": _struct(("id", _L), ("text", _S)),
    "relationships": _struct(("source_id", _L), ("target_id", _L),
                             ("relationship_type", _S), ("created_at", _S),
                             ("updated_at", _S), ("user_id", _L),
                             ("confirmed_by", _L)),
    "versions": _struct(("id", _L), ("item_type", _S), ("item_id", _S),
                        ("event_type", _S), ("associated_id", _L),
                        ("associated_type", _S), ("whodunnit", _S),
                        ("object_changes", _S), ("created_at", _S)),
    "bot_resources": _struct(("id", _L), ("title", _S)),
}

WORKSPACE_TABLES = tuple(WORKSPACE_SCHEMAS)
