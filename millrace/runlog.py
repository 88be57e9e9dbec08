"""What a job has done, run by run, in a folder that all runs share.

An entry is one small JSON file named by its version. A run reads the last version, does its work and
puts the next one; putting fails if another run was faster, so of two runs from the same state only
one takes effect. The entry is the commit: data that no entry names is not there for its readers.
It appears whole or not at all, as it is written aside and renamed. That needs a store in which a
rename onto a name that exists fails, as in HDFS and POSIX folders.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

_ENTRY = re.compile(r"v([0-9]{12})\.json")


class Conflict(Exception):
    """Another run put the same version first."""


@dataclass(frozen=True)
class Entry:
    version: int
    content: dict = field(default_factory=dict)


class RunLog:
    """The log of one job below ``path``. Job names are letters, digits, and . _ - only."""

    def __init__(self, spark: SparkSession, path: str, job: str):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", job) or job.strip(".") == "":
            raise ValueError(f"{job!r} is no job name")
        self.spark, self.folder = spark, f"{path.rstrip('/')}/{job}"
        self._jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _file(self, version: int):
        return self._fs.makeQualified(self._path(f"{self.folder}/v{version:012d}.json"))

    def versions(self) -> list[int]:
        """All versions, the oldest first."""
        folder = self._path(self.folder)
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(m[1]) for m in map(_ENTRY.fullmatch, names) if m)

    def get(self, version: int) -> Entry | None:
        path = self._file(version)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return Entry(version, json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def last(self) -> Entry:
        """The newest entry; version 0, which is empty, before the first run."""
        versions = self.versions()
        return self.get(versions[-1]) if versions else Entry(0)

    def entries(self) -> list[Entry]:
        return [self.get(v) for v in self.versions()]

    def put(self, version: int, content: dict) -> Entry:
        """Put an entry that must not be there yet."""
        aside, there = self._fs.makeQualified(self._path(f"{self.folder}/.{uuid.uuid4().hex}")), self._file(version)
        self._fs.mkdirs(self._path(self.folder))
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True, default=str).encode()))
        finally:
            stream.close()
        none = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(none, 1)
        options[0] = none.NONE
        try:
            self._context.rename(aside, there, options)
        except Exception as e:
            self._fs.delete(aside, False)
            if self._fs.exists(there):
                raise Conflict(f"version {version} of {self.folder} is there already") from e
            raise
        return Entry(version, content)
