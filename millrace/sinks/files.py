"""Published folders: Parquet, delimited, JSON lines, run files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.render import timestamp_text, value_text

#: Codecs by format (fixed values).
CODECS = {"parquet": ("none", "snappy", "gzip", "zstd"), "csv": ("none", "gzip", "bzip2", "snappy"), "json": ("none", "gzip", "bzip2", "snappy")}


def _codec(fmt: str, codec: str) -> str:
    if codec not in CODECS[fmt]:
        raise ValueError(f"{fmt} cannot be written with {codec!r}, only with one of {CODECS[fmt]}")
    return codec


def _parts(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def with_lineage(df: DataFrame) -> DataFrame:
    """_ingested_at as required text, and _source_file "unknown" where a file source lost it."""
    out = df.withColumn("_ingested_at", F.coalesce(timestamp_text(F.col("_ingested_at")), F.lit("unknown")) if "_ingested_at" in df.columns else F.lit("unknown"))
    if "_source_file" in df.columns:
        out = out.withColumn("_source_file", F.coalesce(F.nullif("_source_file", F.lit("")), F.lit("unknown")))
    return out


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", single_file: bool = False, mode: str = "errorifexists") -> None:
    _parts(df, single_file).write.mode(mode).option("compression", _codec("parquet", compression)).parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True, line_sep: str = "\n", compression: str = "none", single_file: bool = False, mode: str = "errorifexists") -> None:
    """NULL and empty text are both written as nothing; floats have no exponent, times are RFC 3339 in UTC."""
    text = df.select(*(value_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))
    writer = _parts(text, single_file).write.mode(mode).option("sep", sep).option("header", header).option("lineSep", line_sep).option("nullValue", "").option("emptyValue", "").option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("compression", _codec("csv", compression)).csv(path)


def write_json_lines(df: DataFrame, path: str, compression: str = "none", single_file: bool = False, mode: str = "errorifexists") -> None:
    """One object per line, NULLs kept."""
    plain = df.select(*((value_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType) else F.col(f"`{f.name}`")) for f in df.schema.fields))
    _parts(plain, single_file).write.mode(mode).option("ignoreNullFields", False).option("compression", _codec("json", compression)).json(path)


def write_quarantine(dlq: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A run that is started again after an error replaces what it left."""
    write_json_lines(dlq, f"{path}/dead_letters", mode=mode)


def write_audit(audit: DataFrame, path: str, mode: str = "overwrite") -> None:
    """In a folder of its own beside the dead letters."""
    write_json_lines(audit, f"{path}/audit", mode=mode)


def write_run_file(spark: SparkSession, path: str, content: dict) -> None:
    """One small JSON file, written by Spark so that it reaches any store."""
    spark.createDataFrame([(json.dumps(content, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def published(spark: SparkSession, path: str) -> bool:
    """Is the folder complete?"""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
