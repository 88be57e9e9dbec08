"""Files as text columns: delimited, JSON lines and JSON arrays.

Everything is read as text, so that bad values reach validation instead of becoming NULL.
Globs, path lists, splits and codecs (by extension: gzip, bzip2, zstandard) are Spark's own.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import BLANK, clean
from ..schema import Schema
from ..stores import open_store

#: The first bytes of the framed snappy format, which Spark's readers cannot take (fixed value).
SNAPPY_MAGIC = bytes.fromhex("ff060000734e61507059")
CHARSETS = {"latin1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1", "windows-1252": "windows-1252", "utf-8": "UTF-8", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE"}


def pick_paths(paths: Sequence[str] | None = None, path: str | None = None) -> list[str]:
    """A list of paths wins over a single one."""
    if paths:
        return list(paths)
    if path:
        return [path]
    raise ValueError("no path is given")


def _charset(name: str) -> str:
    try:
        return CHARSETS[name.lower()]
    except KeyError:
        raise ValueError(f"charset {name!r} is not one of {sorted(CHARSETS)}") from None


class _Heads:
    """The beginnings of files, through the store's own file system and codecs: a few bytes of each."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.codecs = self.jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self.conf)

    def _path(self, uri: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.jvm.java.net.URI(uri))

    def first_bytes(self, uri: str, n: int) -> bytes:
        path = self._path(uri)
        stream = path.getFileSystem(self.conf).open(path)
        try:
            return bytes(stream.readNBytes(n))
        finally:
            stream.close()

    def first_line(self, uri: str, charset: str) -> str | None:
        """The first line that is not blank; None: there is none."""
        path = self._path(uri)
        stream = path.getFileSystem(self.conf).open(path)
        try:
            codec = self.codecs.getCodec(path)
            reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, charset))
            while (line := reader.readLine()) is not None:
                if line.strip("\ufeff" + BLANK):
                    return line.removeprefix("\ufeff")
            return None
        finally:
            stream.close()


def _each(files: Sequence[str], f) -> list:
    """``f`` of every file, many at once: they wait for the store."""
    with ThreadPoolExecutor(32) as pool:
        return list(pool.map(f, files))


#: Files whose first lines the driver reads itself; more are dealt to tasks.
FEW_FILES = 64
#: Bytes of a file's beginning that tasks look for its first line in.
HEAD = 1 << 16


def _task_heads(charset: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame["path"]:
                line, told = None, False
                try:
                    fs, name = open_store(path)
                    codec = {"gz": "gzip", "bz2": "bz2", "zst": "zstd"}.get(path.rpartition(".")[2].lower())
                    with fs.open_input_stream(name, compression=codec) as stream:
                        head = stream.read(HEAD)
                    lines = [x for x in head.decode(charset, "replace").split("\n") if x.strip("\ufeff" + BLANK)]
                    # a head without a line end may have been cut short
                    told = len(head) < HEAD or len(lines) > 1
                    line = lines[0].removeprefix("\ufeff") if lines else None
                except Exception:  # a store or codec that only the JVM knows: the driver looks
                    told = False
                rows.append((path, line, told))
            yield pd.DataFrame(rows, columns=["path", "line", "told"])

    return run


def first_lines(spark: SparkSession, files: Sequence[str], charset: str) -> list[str | None]:
    """The first line of each file that is not blank, None where there is none."""
    found: dict[str, str | None] = {}
    if len(files) > FEW_FILES:
        tasks = min(len(files) // 16, 4 * spark.sparkContext.defaultParallelism)
        rows = spark.createDataFrame([(f,) for f in files], "path string").repartition(tasks).mapInPandas(_task_heads(charset), "path string, line string, told boolean")
        found = {r["path"]: r["line"] for r in rows.where("told").collect()}  # a line per file
    heads, left = _Heads(spark), [f for f in files if f not in found]
    found |= zip(left, _each(left, lambda f: heads.first_line(f, charset)), strict=True)
    return [found[f] for f in files]


@contextmanager
def split_reads(spark: SparkSession, split_bytes: int) -> Iterator[None]:
    """Files that are read in here, by the actions too, are cut into splits of so many bytes if their codec allows it."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def refuse_framed_snappy(spark: SparkSession, paths: Sequence[str]) -> None:
    """Raise before a task would run out of memory on a framed snappy file."""
    named = [p for p in paths if p.lower().endswith((".sz", ".snappy"))]
    if named:
        files = spark.read.text(named).inputFiles()
        for file, head in zip(files, _each(files, lambda f: _Heads(spark).first_bytes(f, len(SNAPPY_MAGIC))), strict=True):
            if head == SNAPPY_MAGIC:
                raise ValueError(f"{file} is framed snappy, which cannot be read; use gzip, bzip2 or zstandard")


def files_with_header(spark: SparkSession, paths: Sequence[str], name: str, sep: str, charset: str) -> tuple[list[str], list[str]]:
    """(with, without): the files below ``paths`` whose first row begins with the cell ``name``, in any
    case, and the others. Files without a row are in neither. Only the first line of a file is read."""
    files = spark.read.text(list(paths)).inputFiles()
    heads = _Heads(spark)
    first = lambda line: next(csv.reader([line], delimiter=sep), [""])[:1] or [""]
    found: tuple[list[str], list[str]] = ([], [])
    for file, line in zip(files, first_lines(spark, files, charset), strict=True):
        if line is not None:
            found[first(line)[0].strip(BLANK).lower() != name.lower()].append(heads._path(file).toString())
    return found


def read_delimited(spark: SparkSession, paths: Sequence[str], schema: Schema, sep: str = ",", header: str = "auto", charset: str = "utf-8", multiline: bool = False) -> DataFrame:
    """CSV, TSV and the like: the schema's columns by position, trimmed, empty ones NULL, and _source_file.

    Short rows are padded with NULL, extra cells and blank lines dropped, stray quotes kept.
    ``header``: "true", "false", or "auto", which leaves out the first row of a file if its first
    cell is the first field's name, in any case; a later row like that is data. "true" raises if
    a file has no such row. ``multiline`` lets quoted cells hold line ends and makes a file one task.
    """
    if header not in ("auto", "true", "false"):
        raise ValueError(f"header is {header!r}, not auto, true or false")
    refuse_framed_snappy(spark, paths)
    reader = spark.read.schema(schema.raw()).option("sep", sep).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", True).option("encoding", _charset(charset)).option("multiLine", multiline)
    if not multiline:
        reader = reader.option("lineSep", "\n")  # wide charsets need it
    parts = [(list(paths), False)]
    if header != "false":
        headed, plain = files_with_header(spark, paths, schema.fields[0].name, sep, _charset(charset))
        if header == "true" and plain:
            raise ValueError(f"{plain[0]} has no header")
        # one scan where all files agree
        parts = [(headed, True), (plain, False)] if headed and plain else [(list(paths), bool(headed))]
    cells = [clean(F.col(f"`{n}`")).alias(n) for n in schema.names]
    return reduce(DataFrame.union, [reader.option("header", h).csv(p).select(*cells, F.col("_metadata.file_path").alias("_source_file")) for p, h in parts])


def _decoded(raw: Column, charset: str) -> Column:
    """The text of bytes that were read as if they were UTF-8."""
    if charset == "UTF-8":
        return raw
    if charset != "windows-1252":
        return F.decode(raw.cast("binary"), charset)
    # Spark decodes Latin-1 only, which differs in these 32 bytes
    control = bytes(range(0x80, 0xA0))
    return F.translate(F.decode(raw.cast("binary"), "ISO-8859-1"), control.decode("latin1"), control.decode("cp1252", "replace"))


def _lines(spark: SparkSession, paths: Sequence[str], charset: str) -> DataFrame:
    """(line, _source_file) of texts, decoded, without blank lines, the byte order mark and carriage returns."""
    raw = spark.read.option("lineSep", "\n").option("encoding", charset).text(list(paths))
    line = F.rtrim(F.ltrim(_decoded(F.col("value"), charset), F.lit("\ufeff")), F.lit("\r"))
    return raw.select(line.alias("line"), F.col("_metadata.file_path").alias("_source_file")).where(clean(F.col("line")).isNotNull())


def parse_json_lines(lines: DataFrame, schema: Schema, line: str = "line") -> DataFrame:
    """The schema's columns by name as text, _corrupt_record, and all other columns of ``lines``.

    A line must be one JSON object and nothing else. It is parsed as an array of the line and a
    mark, so that an object that is cut short, two objects on a line, or anything after an object is
    malformed; its text is then in _corrupt_record and the schema's columns are NULL.
    """
    mark = "_end"
    while mark in schema.names:
        mark += "_"
    fields = T.ArrayType(T.StructType([*schema.raw().fields, T.StructField(mark, T.StringType())]))
    whole = F.concat(F.lit("["), F.col(line), F.lit(f',{{"{mark}":"{mark}"}}]'))
    parsed = lines.withColumn("_parsed", F.from_json(whole, fields, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}))
    good = F.coalesce((F.size("_parsed") == 2) & F.col("_parsed")[0].isNotNull() & F.col("_parsed")[1][mark].eqNullSafe(F.lit(mark)), F.lit(False))
    parsed = parsed.withColumn("_good", good)
    cells = [F.when(F.col("_good"), F.col("_parsed")[0][n]).alias(n) for n in schema.names]
    return parsed.select(*cells, F.when(~F.col("_good"), F.col(line)).alias("_corrupt_record"), *(c for c in lines.columns if c != line))


def read_json(spark: SparkSession, paths: Sequence[str], schema: Schema, array: bool = False, on_malformed: str = "fail", charset: str = "utf-8") -> DataFrame:
    """JSON lines, or files that hold one array: the schema's columns by name as text, and _source_file.

    Numbers keep all their digits, nested values stay JSON text, missing keys are NULL. A malformed
    line, or file of an array, fails the read. With on_malformed="quarantine" it comes back with its text in
    _corrupt_record and all else NULL, which ``validate`` makes a dead letter.
    """
    if on_malformed not in ("fail", "quarantine"):
        raise ValueError(f"on_malformed is {on_malformed!r}, not fail or quarantine")
    refuse_framed_snappy(spark, paths)
    if not array:
        rows = parse_json_lines(_lines(spark, paths, _charset(charset)), schema)
        if on_malformed == "quarantine":
            return rows
        stop = F.raise_error(F.concat(F.lit("malformed record in "), F.col("_source_file"), F.lit(": "), F.left("_corrupt_record", F.lit(200))))
        # a filter, as a column would not be looked at by a query that does not need it
        return rows.where(F.when(F.col("_corrupt_record").isNull(), F.lit(True)).otherwise(stop)).drop("_corrupt_record")
    struct = schema.raw()
    reader = spark.read.option("multiLine", True).option("encoding", _charset(charset))
    if on_malformed == "fail":
        df = reader.option("mode", "FAILFAST").schema(struct).json(list(paths))
        return df.select("*", F.col("_metadata.file_path").alias("_source_file"))
    struct = T.StructType([*struct.fields, T.StructField("_corrupt_record", T.StringType())])
    df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(struct).json(list(paths))
    # a query may need nothing but the malformed records, which the reader does not allow: this one needs a field too
    corrupt = F.when(F.col("_corrupt_record").isNotNull() | F.col(f"`{schema.names[0]}`").isNotNull(), F.col("_corrupt_record"))
    return df.select(*schema.names, corrupt.alias("_corrupt_record"), F.col("_metadata.file_path").alias("_source_file"))
