"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix=f"millrace-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir. In local mode,
    where driver and executors are one machine, it may be unset: then below a temporary one.
    Elsewhere that is an error, as every machine would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _own_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, there = _at(spark, path)
    return fs.exists(there)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its store; the target must not be there yet."""
    fs, there = _at(spark, target)
    if fs.exists(there):
        raise ValueError(f"{target} is there already")
    fs.mkdirs(there.getParent())
    if not fs.rename(_at(spark, source)[1], there):
        raise OSError(f"{source} cannot be renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this program made."""
    fs, there = _at(spark, path)
    fs.delete(there, True)
