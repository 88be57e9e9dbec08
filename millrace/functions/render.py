"""Values as text and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain_float(c: Column) -> Column:
    """A double without an exponent: exact below 10^20, shortest digits otherwise as Spark prints them."""
    text = F.regexp_replace(F.regexp_replace(c.try_cast("decimal(38,17)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    short = c.cast("string")
    return F.when(short.contains("E"), F.coalesce(text, short)).otherwise(F.regexp_replace(short, r"\.0$", ""))


def timestamp_text(c: Column, naive: bool = False) -> Column:
    """RFC 3339 in UTC; the fraction only if there is one. ``naive``: a time without a zone, taken as UTC."""
    utc = c.cast("timestamp") if naive else F.to_utc_timestamp(c, F.current_timezone())
    head = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.regexp_replace(F.date_format(utc, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(head, fraction, F.lit("Z"))


def value_text(c: Column, kind: T.DataType) -> Column:
    """A value as text: floats without exponent, UTC times, true/false, decimals with all their digits."""
    if isinstance(kind, T.DoubleType | T.FloatType):
        return plain_float(c)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return timestamp_text(c, isinstance(kind, T.TimestampNTZType))
    if isinstance(kind, T.BinaryType):
        return F.decode(c, "UTF-8")
    return c.cast("string")


def json_row(df: DataFrame, keep_nulls: bool = True) -> Column:
    """All columns as one JSON object, with NULLs or without."""
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": str(not keep_nulls).lower()})


def row_hash(*cols: Column) -> Column:
    """SHA-256 of the columns' text; NULL and empty text differ, and so do shifted values."""
    return F.sha2(F.to_json(F.array(*(c.cast("string") for c in cols))), 256)
