"""Redaction of sensitive columns and of sensitive values inside JSON payloads."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REDACTED = "[REDACTED]"
#: A column whose name holds one of these is sensitive (fixed values).
KEYWORDS = ("password", "secret", "token", "apikey", "api_key", "auth", "credential", "private_key")
#: Keys of JSON payloads that hold one of these are sensitive (fixed values).
PAYLOAD_KEYWORDS = ("password", "secret", "token", "apikey", "api_key", "auth", "credential", "cpf")


def is_sensitive(name: str, custom: Iterable[str] = ()) -> bool:
    low = name.strip().lower()
    return any(k in low for k in KEYWORDS) or low in {c.strip().lower() for c in custom}


def redact_columns(df: DataFrame, custom: Iterable[str] = ()) -> DataFrame:
    """Sensitive columns, by name, become the sentinel; NULLs too."""
    custom = list(custom)
    return df.select(*(F.lit(REDACTED).alias(c) if is_sensitive(c, custom) else F.col(f"`{c}`") for c in df.columns))


#: The inside of a JSON string, escapes and all. Possessive, so that a long string takes no stack.
_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+'


def redact_payload(payload: Column, custom: Iterable[str] = ()) -> Column:
    """Values of sensitive keys in a JSON text become the sentinel: texts, numbers, booleans and flat arrays.

    A key is sensitive if it holds one of the keywords or is one of the ``custom`` names, in any case.
    Objects are left to the keys inside them; null and empty texts stay. What is no JSON is searched alike.
    """
    words, names = "|".join(PAYLOAD_KEYWORDS), "".join(f'|{re.escape(n)}"' for n in custom if n)
    key = rf'(?<!\\)"(?=[^"]*?(?:{words}){names})({_STRING})"\s*+:\s*+'
    value = rf'(?:"(?!")(?s:{_STRING})"|-?[0-9][0-9.eE+-]*+|true\b|false\b|\[(?:[^\[\]{{}}"]++|"(?s:{_STRING})")*+\])'
    return F.regexp_replace(payload, f"(?i){key}{value}", rf'"$1":"{REDACTED}"')


def has_redaction(text: Column) -> Column:
    return F.contains(text, F.lit(REDACTED))
