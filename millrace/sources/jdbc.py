"""Relational tables, read by key slices."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import Mark, incremental_query
from ..operators.slices import Slice, bounds_query, collect_slices, contiguous, exact_buckets

#: Driver classes by the names that a source may give (fixed values).
DRIVERS = {"postgres": "org.postgresql.Driver", "pgx": "org.postgresql.Driver", "cockroach": "org.postgresql.Driver", "mysql": "com.mysql.cj.jdbc.Driver", "mariadb": "org.mariadb.jdbc.Driver", "derby": "org.apache.derby.jdbc.EmbeddedDriver"}


def literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def source_query(table: str = "", columns: tuple[str, ...] = (), query_filter: str = "", query: str = "") -> str:
    """A full query, or one of a table's columns and filter; both go to the database."""
    if query:
        return query.strip()
    where = f" WHERE {query_filter}" if query_filter else ""
    return f"SELECT {', '.join(columns) or '*'} FROM {table}{where}"


def read_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, f"({query}) src", properties=dict(properties or {}))


def read_slices(spark: SparkSession, url: str, query: str, key: str, batch_size: int, properties: Mapping[str, str] | None = None, mark: Mark | None = None, bounds: str = "database") -> DataFrame:
    """The rows of ``query`` beyond the mark, one partition per slice of ``batch_size`` rows by rank.

    The database cuts the bounds, or Spark does from the keys alone (bounds="spark", for databases
    without window functions). They and the slices are separate queries: the open first and
    last slices lose no row that comes in between, but there is no snapshot across slices.
    """
    query, properties = incremental_query(query, mark), dict(properties or {})
    if bounds == "spark":
        buckets = exact_buckets(spark.read.jdbc(url, f"(SELECT {key} FROM ({query}) src) k", properties=properties), key, batch_size)
    elif bounds == "database":
        buckets = spark.read.jdbc(url, f"({bounds_query(query, key, batch_size).rpartition(' ORDER BY ')[0]}) b", properties=properties)
        buckets = buckets.select(*(F.col(c).alias(c.lower()) for c in buckets.columns))
    else:
        raise ValueError(f"bounds is {bounds!r}, not database or spark")
    slices: list[Slice] = collect_slices(contiguous(buckets))
    predicates = [s.predicate(key, literal) or "1 = 1" for s in slices]
    return spark.read.jdbc(url, f"({query}) src", predicates=predicates, properties=properties)
