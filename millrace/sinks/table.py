"""A table of the catalog as a sink: written at once, or staged, counted and then committed under a run's id."""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import parquet_rows
from ..workspace import exists, move, remove

MODES = ("append", "truncate", "empty")
#: The partition column of tables that are committed by run.
RUN = "_run_id"


def _check(dataset: str, table: str, disposition: str) -> None:
    if not dataset or not table:
        raise ValueError("a table sink needs a dataset and a table")
    if disposition not in MODES:
        raise ValueError(f"write disposition is {disposition!r}, not one of {MODES}")


def write_table(df: DataFrame, dataset: str, table: str, disposition: str = "append") -> None:
    """append; truncate: replace what is there; empty: fail unless the table is missing or has no row."""
    _check(dataset, table, disposition)
    spark, name = df.sparkSession, f"`{dataset}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")
    there = spark.catalog.tableExists(f"{dataset}.{table}")
    if disposition == "empty" and there and not spark.table(name).isEmpty():
        raise ValueError(f"table {dataset}.{table} is not empty")
    if not there:
        df.write.format("parquet").saveAsTable(name)
    else:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=disposition == "truncate")


@dataclass(frozen=True)
class Staged:
    """Rows that are written and counted, but in no table yet."""

    dataset: str
    table: str
    disposition: str
    run_id: str
    path: str
    rows: int


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def stage_table(df: DataFrame, dataset: str, table: str, disposition: str = "append", run_id: str = "") -> Staged:
    """Write the rows beside the table, which is made if it is missing, and count what is there, by the files' footers.

    The table is partitioned by the run. A run id that is no plain name is replaced by its digest; without
    one, the run can't be told from others, and a rerun adds its rows again.
    """
    _check(dataset, table, disposition)
    run_id = run_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        run_id = hashlib.sha256(run_id.encode()).hexdigest()
    spark, name = df.sparkSession, f"`{dataset}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")
    if not spark.catalog.tableExists(f"{dataset}.{table}"):
        df.limit(0).withColumn(RUN, F.lit("")).write.format("parquet").partitionBy(RUN).saveAsTable(name)
    columns = spark.table(name).columns
    if sorted(c for c in columns if c != RUN) != sorted(df.columns):
        raise ValueError(f"table {dataset}.{table} has the columns {columns}, not {df.columns}")
    base = spark.catalog.getDatabase(dataset).locationUri
    path = f"{base.rstrip('/')}/.staged/{table}/{uuid.uuid4().hex}"
    df.select(*(c for c in columns if c != RUN)).write.parquet(path)
    return Staged(dataset, table, disposition, run_id, path, parquet_rows(spark, path))


def commit_table(spark: SparkSession, staged: Staged) -> None:
    """Let the staged rows be the run's partition of the table.

    They are moved, not copied, and take the place of what an earlier try of the same run has left, so a run
    that is started again adds nothing. "truncate" drops the partitions of other runs; "empty" fails if
    they have rows. A table that is not partitioned by run gets the rows by an insert.
    """
    name = f"`{staged.dataset}`.`{staged.table}`"
    facts = _facts(spark, name)
    if RUN not in spark.table(name).columns:
        write_table(spark.read.parquet(staged.path), staged.dataset, staged.table, staged.disposition)
        remove(spark, staged.path)
        return
    others = spark.table(name).where(F.col(RUN) != staged.run_id)
    if staged.disposition == "empty" and not others.isEmpty():
        raise ValueError(f"table {staged.dataset}.{staged.table} is not empty")
    drop = [r[RUN] for r in others.select(RUN).distinct().collect()] if staged.disposition == "truncate" else []  # as many as runs
    at = lambda run: f"{facts['Location'].rstrip('/')}/{RUN}={run}"
    tracked = facts.get("Partition Provider") == "Catalog"
    if exists(spark, at(staged.run_id)):
        remove(spark, at(staged.run_id))
    move(spark, staged.path, at(staged.run_id))
    if tracked:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({RUN} = '{staged.run_id}')")
    for run in drop:
        if tracked:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({RUN} = '{run}')")
        remove(spark, at(run))
    spark.catalog.refreshTable(f"{staged.dataset}.{staged.table}")
