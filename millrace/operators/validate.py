"""Cast, check and split rows in one pass: valid rows, dead letters and audit events.

Trimmed texts are projected first, typed values from them in a second projection and errors in
a third, so no text is trimmed and no cast is evaluated twice. The frame with both is the single source of all three outputs:
persist it (``Validated.persist``) before more than one of them is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import cast_text, cast_value
from ..functions.privacy import REDACTED, is_sensitive, redact_payload
from ..schema import Schema

NULL_CAUSE = "non-nullable constraint violation"
CAST_CAUSE = "type cast failed"
MALFORMED = "malformed record"
#: Characters of a malformed record that its audit event shows.
SAMPLE = 200
ACTIONS = ("warn", "quarantine", "fail")


@dataclass(frozen=True)
class Rule:
    """A row rule: ``not_null`` or ``accepted_values`` on a column, or ``condition``, a Column over
    the typed values that must hold (``column`` then names the column that is blamed)."""

    type: str
    column: str
    values: tuple[str, ...] = ()
    condition: Column | None = None
    action: str = ""

    def __post_init__(self) -> None:
        if self.type not in ("not_null", "accepted_values", "condition"):
            raise ValueError(f"unknown rule {self.type!r}")
        if self.type == "condition" and self.condition is None:
            raise ValueError("a condition rule needs a condition")
        if not self.action:
            object.__setattr__(self, "action", "warn" if self.type == "not_null" else "quarantine")
        if self.action not in ACTIONS:
            raise ValueError(f"action is {self.action!r}, not one of {ACTIONS}")

    def broken(self) -> Column:
        c = F.col(f"`{self.column}`")
        if self.type == "not_null":
            return c.isNull()
        if self.type == "accepted_values":
            return F.coalesce(~c.cast("string").isin(*self.values), F.lit(False))
        return ~F.coalesce(self.condition, F.lit(False))

    @property
    def message(self) -> str:
        if self.type == "not_null":
            return f'soft quality warning: column "{self.column}" is null' if self.action == "warn" else f'column "{self.column}" is null'
        if self.type == "accepted_values":
            return f'column "{self.column}" has a value that is not accepted'
        return f'condition on column "{self.column}" does not hold'


@dataclass(frozen=True)
class Run:
    """What a run adds to its rows. The time is taken once, on the driver, so retried tasks agree."""

    time: datetime = field(default_factory=lambda: datetime.now(UTC).replace(microsecond=0))
    job_id: str = ""
    execution_id: str = ""
    pipeline_id: str = ""

    def timestamp(self) -> Column:
        return F.timestamp_micros(F.lit(round(self.time.timestamp() * 1_000_000)))


@dataclass
class Validated:
    tagged: DataFrame
    schema: Schema
    rules: tuple[Rule, ...]
    run: Run
    sensitive: tuple[str, ...]
    #: Does the source tell malformed records? They are the first failure there is.
    malformed: bool = False

    def persist(self) -> Validated:
        self.tagged.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        self.tagged.unpersist()

    @property
    def valid(self) -> DataFrame:
        """Typed rows with _source_file and _origin, and the run's audit columns."""
        kept = self.tagged.where("_failure IS NULL")
        return kept.select(*(F.col(f"_v_{i}").alias(n) for i, n in enumerate(self.schema.names)), "_source_file", "_origin", "_ingested_at", "_job_id", "_execution_id")

    @property
    def dlq(self) -> DataFrame:
        """One dead letter per failing row, sensitive values redacted in payload and message."""
        cells = [F.lit(REDACTED) if is_sensitive(n, self.sensitive) else F.coalesce(F.col(f"_r_{i}"), F.lit("")) for i, n in enumerate(self.schema.names)]
        payload = redact_payload(F.concat(F.lit("["), F.concat_ws(" ", *cells), F.lit("]")), self.sensitive)
        if self.malformed:
            payload = F.when(F.col("_failure") == 0, redact_payload(F.col("_record"), self.sensitive)).otherwise(payload)
        return self.tagged.where("_failure IS NOT NULL").select(payload.alias("raw_payload"), F.col("_message").alias("error_message"), F.col("_failed_column").alias("failed_column"), "_source_file", self.run.timestamp().alias("_failed_at"), "_origin")

    def _event(self) -> Column:
        kind = F.lit("type_cast_failure")
        return F.when(F.col("_failure") == 0, F.lit("malformed_record")).otherwise(kind) if self.malformed else kind

    @property
    def audit(self) -> DataFrame:
        """An ERROR event per failing row and a WARNING per soft rule that a valid row breaks."""
        event = lambda kind, severity, column, rule, message, sample: F.struct(kind.alias("event_type"), F.lit(severity).alias("severity"), column.alias("column_name"), rule.alias("rule_name"), message.alias("message"), sample.alias("sample_value"))
        failed = F.col("_failure").isNotNull()
        events = [F.when(failed, event(self._event(), "ERROR", F.col("_failed_column"), F.col("_failed_rule"), F.col("_message"), F.col("_sample")))]
        for i, r in enumerate(self.rules):
            if r.action == "warn":
                events.append(F.when(~failed & F.col(f"_broken_{i}"), event(F.lit("quality_warning"), "WARNING", F.lit(r.column), F.lit(r.type), F.lit(r.message), F.lit(""))))
        rows = self.tagged.select(F.explode(F.filter(F.array(*events), lambda e: e.isNotNull())).alias("e"))
        return rows.select(self.run.timestamp().alias("timestamp"), "e.*", F.lit(self.run.pipeline_id).alias("pipeline_id"), F.lit(self.run.execution_id).alias("run_id"))

    def broken(self, action: str) -> DataFrame:
        """Valid rows per rule that has ``action``: (rule, column_name, n), rules nothing breaks left out."""
        kept = self.tagged.where("_failure IS NULL")
        counts = [F.struct(F.lit(r.type).alias("rule"), F.lit(r.column).alias("column_name"), F.count_if(F.col(f"_broken_{i}")).alias("n")) for i, r in enumerate(self.rules) if r.action == action]
        if not counts:
            return kept.sparkSession.createDataFrame([], "rule string, column_name string, n long")
        return kept.agg(F.array(*counts).alias("r")).select(F.inline("r")).where("n > 0")


def validate(df: DataFrame, schema: Schema, rules: Sequence[Rule] = (), sensitive: Sequence[str] = (), run: Run | None = None, schema_id: str = "", trim: bool = True, source_file: str = "_source_file", corrupt: str = "_corrupt_record", origin: Column | None = None) -> Validated:
    """Validate the text columns of ``df`` against ``schema``; fields in schema order, the first failure wins.

    ``origin`` overrides the origin: source file, else schema id, else "default". A column named
    ``corrupt``, unless the schema has it, tells records that a reader could not parse: such a row fails
    before all else, its text is the dead letter's payload and no column is blamed.
    """
    run, rules, sensitive = run or Run(), tuple(rules), tuple(sensitive)
    names = schema.names
    missing = [r.column for r in rules if r.column not in names]
    if missing:
        raise ValueError(f"rules name columns that the schema lacks: {missing}")
    source = F.col(source_file) if source_file in df.columns else F.lit(None).cast("string")
    where = origin if origin is not None else F.coalesce(F.nullif(source, F.lit("")), F.nullif(F.lit(schema_id), F.lit("")), F.lit("default"))
    ingested = F.coalesce(F.col("_ingested_at").cast("timestamp"), run.timestamp()) if "_ingested_at" in df.columns else run.timestamp()
    extra = [source.alias("_source_file"), where.alias("_origin"), ingested.alias("_ingested_at"), F.lit(run.job_id).alias("_job_id"), F.lit(run.execution_id).alias("_execution_id")]
    have = {c.lower() for c in df.columns}
    malformed = corrupt in df.columns and corrupt not in names
    if malformed:
        extra.append(F.col(f"`{corrupt}`").cast("string").alias("_record"))
    if "_api_calls" in df.columns and "_api_calls" not in names:
        extra.append(F.col("_api_calls").cast("bigint").alias("_calls"))
    raw = {f.name: (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast("string") for f in schema.fields}
    # plain columns: the optimizer would put a struct's fields back in wherever they are used
    texts = df.select(
        *(raw[n].alias(f"_r_{i}") for i, n in enumerate(names)),
        *(cast_text(raw[f.name], f, trim).alias(f"_t_{i}") for i, f in enumerate(schema.fields)),
        *extra,
    )
    typed = texts.select("*", *(cast_value(F.col(f"_t_{i}"), f).alias(f"_v_{i}") for i, f in enumerate(schema.fields)))
    failures = []  # (condition, column, rule, cause, type, value)
    if malformed:
        failures.append((F.col("_record").isNotNull(), None, "parse", MALFORMED, None, F.left(redact_payload(F.col("_record"), sensitive), F.lit(SAMPLE))))
    for i, f in enumerate(schema.fields):
        t, v = F.col(f"_t_{i}"), F.col(f"_v_{i}")
        if not f.nullable:
            failures.append((t.isNull(), f.name, "type_cast", NULL_CAUSE, f.type, F.lit("")))
        if f.type not in ("string", "bytes"):
            failures.append((t.isNotNull() & v.isNull(), f.name, "type_cast", CAST_CAUSE, f.type, t))
    # rules see the typed values under their own names
    flags = [r.broken().alias(f"_broken_{i}") for i, r in enumerate(rules)]
    tagged = typed.select("*", *(F.col(f"_v_{i}").alias(n) for i, n in enumerate(names))).select(*typed.columns, *flags) if rules else typed
    for i, r in enumerate(rules):
        if r.action == "quarantine":
            kind = next(f.type for f in schema.fields if f.name == r.column)
            failures.append((F.col(f"_broken_{i}"), r.column, r.type, r.message, kind, F.col(f"_t_{names.index(r.column)}")))
    which = F.coalesce(*(F.when(cond, F.lit(i)) for i, (cond, *_) in enumerate(failures))) if failures else F.lit(None).cast("int")
    # the partition number changes nothing, but keeps a filter on the index from being copied with all casts below them
    tagged = tagged.withColumn("_failure", F.when(F.spark_partition_id() >= 0, which))

    def pick(value) -> Column:
        out = F.lit(None).cast("string")
        for i, f in reversed(list(enumerate(failures))):
            out = F.when(F.col("_failure") == i, value(f)).otherwise(out)
        return out

    message = lambda f: F.concat(F.lit(f'field "{f[1]}" ({f[4]}) with value "'), shown(f), F.lit(f'": {f[3]}')) if f[1] else F.lit(f[3])
    shown = lambda f: F.lit(REDACTED) if f[1] and is_sensitive(f[1], sensitive) else F.coalesce(f[5], F.lit(""))
    tagged = tagged.select("*", pick(lambda f: F.lit(f[1]).cast("string")).alias("_failed_column"), pick(lambda f: F.lit(f[2])).alias("_failed_rule"), pick(shown).alias("_sample"), pick(message).alias("_message"))
    return Validated(tagged, schema, rules, run, sensitive, malformed)


def drop_null_records(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that are NULL in all ``columns`` are no records."""
    return df.where(F.coalesce(*(F.col(f"`{c}`").cast("string") for c in columns)).isNotNull())

