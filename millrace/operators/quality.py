"""Deduplication, uniqueness and run-level gates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.render import row_hash


class GateError(RuntimeError):
    """A run-level rule does not hold."""


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns..., n) of the keys that occur more than once; NULL keys aside."""
    rows = df.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in columns)))
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def dedup(df: DataFrame, keys: Sequence[str], keep_first_by: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by the given order, of rows that tie there the one whose content
    has the smallest hash (columns of maps aside), so that reruns agree. Reduced to a minimum per
    key before the shuffle, so that a key with very many rows is no hot spot."""
    order = [F.col(c) if isinstance(c, str) else c for c in keep_first_by]
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order.append(F.xxhash64(*plain) if plain else F.lit(0))
    rest = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    first = df.groupBy(*(F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min_by(rest, F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def dedup_rows(df: DataFrame, columns: Sequence[str] | None = None, keep_first_by: Sequence[Column | str] = ()) -> DataFrame:
    """One row per distinct content of ``columns`` (all by default), found by a row hash."""
    hashed = df.withColumn("_row_hash", row_hash(*(F.col(f"`{c}`") for c in columns or df.columns)))
    return dedup(hashed, ["_row_hash"], [*keep_first_by, "_row_hash"]).drop("_row_hash")


def dedup_by_window(df: DataFrame, keys: Sequence[str], keep_first_by: Sequence[Column | str]) -> DataFrame:
    """The same as ``dedup`` by row_number, for orders that min_by cannot compare (descending ones)."""
    order = Window.partitionBy(*keys).orderBy(*keep_first_by)
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


@dataclass(frozen=True)
class Gates:
    """Run-level limits; None: not checked."""

    max_error_percentage: float | None = None
    row_count_min: int | None = None
    row_count_max: int | None = None
    dlq_enabled: bool = True

    def broken(self, total: int, valid: int, dlq: int) -> list[str]:
        out = []
        if self.max_error_percentage is not None and total and 100 * dlq / total > self.max_error_percentage:
            out.append(f"{100 * dlq / total:.4g} % of the rows were quarantined, the limit is {self.max_error_percentage:g} %")
        if self.row_count_min is not None and valid < self.row_count_min:
            out.append(f"{valid} valid rows, at least {self.row_count_min} are asked for")
        if self.row_count_max is not None and valid > self.row_count_max:
            out.append(f"{valid} valid rows, at most {self.row_count_max} are allowed")
        if not self.dlq_enabled and dlq:
            out.append(f"{dlq} rows would be quarantined, but the quarantine is off")
        return out

    def check(self, total: int, valid: int, dlq: int) -> None:
        if reasons := self.broken(total, valid, dlq):
            raise GateError("; ".join(reasons))


def gate_report(tagged: DataFrame, gates: Gates) -> DataFrame:
    """(gate, observed, bound, passed) over a validated frame, in one aggregate."""
    failed = F.col("_failure").isNotNull()
    counts = tagged.agg(F.count("*").alias("total"), F.count_if(failed).alias("dlq"), F.count_if(~failed).alias("valid"))
    row = lambda gate, seen, bound, ok: F.struct(F.lit(gate).alias("gate"), seen.cast("double").alias("observed"), F.lit(float(bound)).alias("bound"), ok.alias("passed"))
    share = F.when(F.col("total") > 0, 100 * F.col("dlq") / F.when(F.col("total") > 0, F.col("total"))).otherwise(0.0)
    rows = []
    if gates.max_error_percentage is not None:
        rows.append(row("max_error_percentage", share, gates.max_error_percentage, share <= gates.max_error_percentage))
    if gates.row_count_min is not None:
        rows.append(row("row_count_min", F.col("valid"), gates.row_count_min, F.col("valid") >= gates.row_count_min))
    if gates.row_count_max is not None:
        rows.append(row("row_count_max", F.col("valid"), gates.row_count_max, F.col("valid") <= gates.row_count_max))
    if not gates.dlq_enabled:
        rows.append(row("dlq_disabled", F.col("dlq"), 0, F.col("dlq") == 0))
    return counts.select(F.inline(F.array(*rows)))
