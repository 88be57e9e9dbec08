"""Strict casts from text. Each is an expression that is NULL where the text is no such value.

Spark's own casts accept more (exponents, NaN, partial dates), so a pattern guards each.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import Field

#: White space that is cut from both ends.
BLANK = " \t\r\n\x0b\x0c"
INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
PLAIN_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?$"
#: The words of booleans (fixed values).
TRUE = ("true", "t", "1", "yes", "y")
FALSE = ("false", "f", "0", "no", "n")


def clean(raw: Column) -> Column:
    """Trimmed; empty text is NULL."""
    return F.nullif(F.btrim(raw, F.lit(BLANK)), F.lit(""))


def int64(text: Column) -> Column:
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def float64(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def boolean(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin(*TRUE), True).when(low.isin(*FALSE), False)


def timestamp(text: Column) -> Column:
    """RFC 3339, or date and time, or a date; the latter two are UTC whatever the session's zone."""
    dotted = F.translate(text, ",", ".")
    return (
        F.when(text.rlike(RFC3339), dotted.try_cast("timestamp"))
        .when(text.rlike(PLAIN_TIME), F.concat(dotted, F.lit("Z")).try_cast("timestamp"))
        .when(text.rlike(DATE), F.concat(text, F.lit(" 00:00:00Z")).try_cast("timestamp"))
    )


def decimal(text: Column, scale: int, on_overflow: str = "round") -> Column:
    """DECIMAL(18, scale): half away from zero, or NULL if a digit would be lost and on_overflow is fail."""
    ok = text.rlike(NUMBER)
    if on_overflow == "fail":
        ok = ok & (F.length(F.regexp_extract(text, r"\.([0-9]*)$", 1)) <= scale)
    return F.when(ok, text.try_cast(f"decimal(18,{scale})"))


def date(text: Column) -> Column:
    return F.when(text.rlike(DATE), text.try_cast("date"))


def json_text(text: Column) -> Column:
    """Text that is one JSON value. The parser ignores what follows a value, so the text is tried
    inside an array and inside an object: nothing but a single value fits into both."""
    parses = lambda before, after: F.try_parse_json(F.concat(F.lit(before), text, F.lit(after))).isNotNull()
    return F.when(parses("[", "]") & parses('{"x":', "}"), text)


def cast_text(raw: Column, field: Field, trim: bool = True) -> Column:
    """The text that is cast. ``trim=False`` leaves text fields as they are, as JSON sources need it."""
    return clean(raw) if trim or field.type not in ("string", "json") else raw


def cast_value(text: Column, field: Field) -> Column:
    """The value of a field's text."""
    return {
        "int64": lambda: int64(text),
        "float64": lambda: float64(text),
        "bool": lambda: boolean(text),
        "timestamp": lambda: timestamp(text),
        "decimal": lambda: decimal(text, field.scale, field.on_overflow),
        "bytes": lambda: F.encode(text, "UTF-8"),
        "date": lambda: date(text),
        "json": lambda: json_text(text),
    }.get(field.type, lambda: text)()


def cast(raw: Column, field: Field, trim: bool = True) -> tuple[Column, Column]:
    """(text, value) of a raw column."""
    text = cast_text(raw, field, trim)
    return text, cast_value(text, field)
