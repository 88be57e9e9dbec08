"""Nested documents and JSON responses as flat records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import Schema


def flatten(df: DataFrame) -> DataFrame:
    """Struct columns become dotted columns, at any depth; arrays and maps become JSON text."""

    def leaves(kind: T.StructType, path: tuple[str, ...]):
        for f in kind.fields:
            at = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, at)
            else:
                c = F.col(".".join(f"`{p}`" for p in at))
                yield (F.to_json(c) if isinstance(f.dataType, T.ArrayType | T.MapType) else c).alias(".".join(at))

    return df.select(*leaves(df.schema, ()))


def json_path(body: Column, path: str) -> Column:
    """The value at a dotted path of a JSON text, as text."""
    return F.get_json_object(body, "$" if path in ("", "$") else "$." + path)


def to_record(df: DataFrame, schema: Schema, body: str = "document") -> DataFrame:
    """The schema's columns, as text, from a column of JSON documents, by dotted name.

    ``id`` and ``_id`` stand for each other; an object id or a date in extended JSON gives its
    text; nested values are JSON text. Validation then casts and finds missing ones.
    """

    def value(name: str) -> Column:
        text = json_path(F.col(body), name)
        inner = F.coalesce(F.get_json_object(text, "$['$oid']"), F.get_json_object(text, "$['$date']"), F.get_json_object(text, "$['$numberLong']"), F.get_json_object(text, "$['$numberDecimal']"))
        return F.when(F.startswith(text, F.lit("{")), F.coalesce(inner, text)).otherwise(text)

    def column(name: str) -> Column:
        if name in ("id", "_id"):
            return F.coalesce(value("_id"), value("id"))
        return value(name)

    rest = [F.col(f"`{c}`") for c in df.columns if c != body]
    return df.select(*(column(n).alias(n) for n in schema.names), *rest)


def extract_records(df: DataFrame, schema: Schema, records_path: str = "", field_mapping: Mapping[str, str] | None = None, body: str = "body") -> DataFrame:
    """One row per object in the array at ``records_path`` of each JSON response.

    A field is read at its path in ``field_mapping``, else at its own name. Items that are no
    objects are skipped; a response whose path holds no array raises an error, a missing one too.
    """
    mapping = dict(field_mapping or {})
    text = json_path(F.col(body), records_path)
    text = F.when(F.startswith(F.ltrim(text), F.lit("[")), text).otherwise(F.raise_error(F.concat(F.lit(f"no array at {records_path or 'the root'} of "), F.substring(F.coalesce(F.col(body), F.lit("NULL")), F.lit(1), F.lit(120)))))
    rest = [F.col(f"`{c}`") for c in df.columns if c != body]
    items = df.select(*rest, F.explode(F.from_json(text, "array<string>")).alias("_item")).where(F.startswith(F.ltrim("_item"), F.lit("{")))
    return items.select(*(json_path(F.col("_item"), mapping.get(n, n)).alias(n) for n in schema.names), *rest)
