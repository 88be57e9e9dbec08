"""Incremental loads: a typed high-water mark that never goes back."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import Schema

KINDS = {"integer": ("int64",), "float": ("float64", "decimal"), "timestamp": ("timestamp",), "date": ("date",), "string": ("string",)}
PLACEHOLDER = ":watermark_value"
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")


@dataclass(frozen=True)
class Mark:
    """A column, the kind of its values, and the last value seen (None: nothing yet)."""

    column: str
    kind: str
    text: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"mark kind is {self.kind!r}, not one of {tuple(KINDS)}")
        if not _IDENTIFIER.fullmatch(self.column):
            raise ValueError(f"{self.column!r} is no plain column name")
        if self.text is not None:
            self.value  # noqa: B018  a bad mark is rejected at once

    def check(self, schema: Schema) -> None:
        field = next((f for f in schema.fields if f.name == self.column), None)
        if field is None:
            raise ValueError(f"the schema has no column {self.column}")
        if field.type not in KINDS[self.kind]:
            raise ValueError(f"column {self.column} is {field.type}, which is no {self.kind}")

    @property
    def value(self) -> int | float | str | datetime | date | None:
        t = self.text
        if t is None:
            return None
        t = t.strip() if self.kind != "string" else t
        if self.kind == "integer":
            if not re.fullmatch(r"[+-]?[0-9]+", t) or not -(1 << 63) <= int(t) < 1 << 63:
                raise ValueError(f"{t!r} is no integer mark")
            return int(t)
        if self.kind == "float":
            try:
                x = float(t)
            except ValueError:
                x = math.nan
            if not math.isfinite(x):
                raise ValueError(f"{t!r} is no float mark")
            return x
        if self.kind == "date":
            try:
                return datetime.strptime(t, "%Y-%m-%d").date()
            except ValueError:
                raise ValueError(f"{t!r} is no date mark") from None
        if self.kind == "timestamp":
            if not re.match(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", t):
                raise ValueError(f"{t!r} is no timestamp mark")
            try:
                x = datetime.fromisoformat(t)
            except ValueError:
                raise ValueError(f"{t!r} is no timestamp mark") from None
            return (x if x.tzinfo else x.replace(tzinfo=UTC)).astimezone(UTC)
        return t

    def canonical(self) -> str | None:
        v = self.value
        if v is None:
            return None
        if isinstance(v, datetime):
            micros = f".{v.microsecond:06d}".rstrip("0") if v.microsecond else ""
            return v.strftime("%Y-%m-%dT%H:%M:%S") + micros + "+00:00"
        if isinstance(v, float):
            return f"{v:.17f}".rstrip("0").rstrip(".") if abs(v) < 1e15 and f"{v:.17f}" and float(f"{v:.17f}") == v else repr(v)
        return str(v)

    def literal(self) -> str:
        """A SQL literal; text is quoted and its quotes are doubled."""
        text = self.canonical()
        if text is None:
            raise ValueError("the mark has no value yet")
        return text if self.kind in ("integer", "float") else "'" + text.replace("'", "''") + "'"

    def compare(self, other: Mark) -> int:
        """-1, 0 or 1: numbers by size, times by instant."""
        a, b = self.value, other.value
        return (a > b) - (a < b)


#: What the values of a mark are read as; a text stays one.
_TYPES = {"integer": "bigint", "float": "double", "date": "date", "string": "string"}


def compared(values: Column, mark: Mark) -> Column:
    """-1, 0 or 1 for each text of a mark's kind, older, equal or newer than ``mark``; null for null.

    Times are compared by instant; those without a zone are UTC, as in marks.
    """
    if mark.value is None:
        raise ValueError("the mark has no value yet")
    if mark.kind == "timestamp":
        t = F.trim(values)
        day, zoned = t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), t.rlike("(?:Z|[+-][0-9]{2}:?[0-9]{2})$")
        x = F.unix_micros(F.when(day, F.concat(t, F.lit("T00:00:00Z"))).when(zoned, t).otherwise(F.concat(t, F.lit("Z"))).cast("timestamp"))
        y = F.unix_micros(F.lit(mark.canonical()).cast("timestamp"))
    else:
        x, y = values.cast(_TYPES[mark.kind]), F.lit(mark.canonical()).cast(_TYPES[mark.kind])
    return F.when(x > y, 1).when(x < y, -1).when(x == y, 0)


def newer(df: DataFrame, mark: Mark) -> DataFrame:
    """Rows strictly beyond the mark; all rows if there is none yet. A typed literal, so it is pushed into the scan."""
    v = mark.value
    if v is None:
        return df
    if isinstance(v, datetime):
        if isinstance(df.schema[mark.column].dataType, T.TimestampNTZType):  # read as UTC
            return df.where(F.col(mark.column) > F.expr(f"TIMESTAMP_NTZ '{v:%Y-%m-%d %H:%M:%S.%f}'"))
        return df.where(F.col(mark.column) > F.timestamp_micros(F.lit(round(v.timestamp() * 1_000_000))))
    return df.where(F.col(mark.column) > F.lit(v))


def incremental_query(query: str, mark: Mark | None) -> str:
    """The query of a run: its placeholder filled in, or else wrapped in a filter beyond the mark."""
    if PLACEHOLDER in query:
        if mark is None or mark.text is None:
            raise ValueError(f"the query has {PLACEHOLDER}, but no mark is given")
        return query.replace(PLACEHOLDER, mark.literal())
    if mark is None or mark.text is None:
        return query
    return f"SELECT * FROM ({query}) newer_rows WHERE {mark.column} > {mark.literal()}"


def next_mark(written: DataFrame, mark: Mark) -> Mark:
    """The largest written value, never less than the incoming one. Nothing written, or only NULLs: the incoming one as it was."""
    c = F.col(mark.column)
    top = F.max(c)
    if mark.kind == "timestamp":
        if isinstance(written.schema[mark.column].dataType, T.TimestampNTZType):  # read as UTC
            top = F.concat(top.cast("string"), F.lit("Z")).cast("timestamp")
        top = F.unix_micros(top)
    elif mark.kind == "date":
        top = top.cast("string")
    got = written.agg(top.alias("top")).first()["top"]
    if got is None:
        return mark
    if mark.kind == "timestamp":
        text = datetime.fromtimestamp(got // 1_000_000, UTC).replace(microsecond=got % 1_000_000).isoformat()
    else:
        text = str(got)
    reached = Mark(mark.column, mark.kind, text)
    reached = Mark(mark.column, mark.kind, reached.canonical())
    return mark if mark.text is not None and mark.compare(reached) >= 0 else reached


def next_offset(offset: int | None, total_read: int) -> int:
    """An offset mark advances by all rows read, quarantined ones too."""
    return (offset or 0) + total_read
