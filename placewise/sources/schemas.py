"""Declared schemas of posts and of the name-to-gender records.

Streams cannot infer a schema, and a sample without a single placed post would
hide ``includes.places``; so the schemas are declared once, as a superset.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DATA = _struct(id=_S, text=_S, author_id=_S, created_at=_S, source=_S)
PLACES = T.ArrayType(_struct(full_name=_S, id=_S))
USERS = T.ArrayType(_struct(id=_S, name=_S, username=_S, location=_S))
POST = _struct(data=DATA, includes=_struct(places=PLACES, users=USERS))

GENDER_RECORD = _struct(
    q=_S, name=_S, gender=_S, country=_S,
    probability=T.LongType(), total_names=T.LongType(),
    used_credits=T.LongType(), remaining_credits=T.LongType(), expires=T.LongType(),
    duration=_S, server=_S, status=T.BooleanType(),
)


def _keep(kind: T.DataType, paths: list[list[str]]) -> T.DataType:
    if not all(paths):
        return kind
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_keep(kind.elementType, paths))
    if not isinstance(kind, T.StructType):
        raise ValueError(f"no such field: {paths[0][0]}")
    unknown = {p[0] for p in paths} - set(kind.names)
    if unknown:
        raise ValueError(f"no such field: {sorted(unknown)}")
    return T.StructType([
        T.StructField(f.name, _keep(f.dataType, [p[1:] for p in paths if p[0] == f.name]))
        for f in kind if any(p[0] == f.name for p in paths)
    ])


def post_schema(*fields: str) -> T.StructType:
    """The post schema narrowed to dotted ``fields``; all of it when none are given.

    A JSON scan parses every declared field, so a narrow schema is what prunes it.
    ``data.id`` is always kept: it marks the line as a post.
    """
    if not fields:
        return POST
    return _keep(POST, [f.split(".") for f in dict.fromkeys(("data.id", *fields))])
