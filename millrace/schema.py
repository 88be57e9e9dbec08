"""Declared schemas: what a source's columns must become."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = ("string", "int64", "float64", "bool", "timestamp", "decimal", "bytes", "date", "json")
OVERFLOW = ("round", "fail")


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    nullable: bool = True
    scale: int = 0
    on_overflow: str = "round"

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise ValueError("a field needs a name")
        if self.type not in TYPES:
            raise ValueError(f"field {self.name}: unknown type {self.type!r}")
        if not 0 <= self.scale <= 18:
            raise ValueError(f"field {self.name}: scale {self.scale} is not within 0 to 18")
        if self.on_overflow not in OVERFLOW:
            raise ValueError(f"field {self.name}: on_overflow is {self.on_overflow!r}, not one of {OVERFLOW}")

    @property
    def spark_type(self) -> T.DataType:
        if self.type == "decimal":
            return T.DecimalType(18, self.scale)
        return {"int64": T.LongType(), "float64": T.DoubleType(), "bool": T.BooleanType(), "timestamp": T.TimestampType(), "bytes": T.BinaryType(), "date": T.DateType()}.get(self.type, T.StringType())


@dataclass(frozen=True)
class Schema:
    fields: tuple[Field, ...]

    def __post_init__(self) -> None:
        if not self.fields:
            raise ValueError("a schema needs a field")
        names = [f.name.lower() for f in self.fields]
        if len(set(names)) < len(names):
            raise ValueError("field names repeat")

    @classmethod
    def of(cls, *fields: Field) -> Schema:
        return cls(tuple(fields))

    @classmethod
    def from_json(cls, text: str) -> Schema:
        """From {"fields": [...]} or a bare list."""
        spec = json.loads(text)
        rows = spec["fields"] if isinstance(spec, dict) else spec
        return cls(tuple(Field(r["name"], r.get("type", "string"), r.get("nullable", True), r.get("scale", 0), r.get("on_overflow") or "round") for r in rows))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])

    def raw(self) -> T.StructType:
        """All columns as text, as sources are read before validation."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])


def first_given(*schemas: Schema | None) -> Schema:
    """The schema of highest precedence: root, database, API, then file source."""
    for s in schemas:
        if s is not None:
            return s
    raise ValueError("no schema is given")


def incompatibilities(old: Schema, new: Schema) -> list[str]:
    """Why ``new`` is no additive evolution of ``old``; empty if it is one.

    Every old field must survive with its type, and every new one must be nullable.
    """
    by_name = {f.name: f for f in new.fields}
    out = []
    for f in old.fields:
        g = by_name.get(f.name)
        if g is None:
            out.append(f"field {f.name} is gone")
        elif (g.type, g.scale if g.type == "decimal" else 0) != (f.type, f.scale if f.type == "decimal" else 0):
            out.append(f"field {f.name} is {g.type}, it was {f.type}")
    known = set(old.names)
    return out + [f"new field {f.name} is not nullable" for f in new.fields if f.name not in known and not f.nullable]


def conform(df: DataFrame, schema: Schema) -> DataFrame:
    """The columns of ``schema`` in its order, NULL for those that ``df`` lacks, nothing else."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*((F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None).cast("string")).alias(f.name) for f in schema.fields))


def union_evolved(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are NULL."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
