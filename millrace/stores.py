"""Files of a store, read and written by tasks without a JVM at hand."""

from __future__ import annotations

from urllib.parse import quote

#: Schemes that Hadoop names otherwise than Arrow does (fixed values).
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def arrow_uri(path: str) -> str:
    """The address of a path as Arrow names it: its scheme, slashes after it, blanks and the like quoted."""
    scheme, colon, rest = path.partition(":")
    if not colon:
        return "file://" + quote(path, safe="/:@=+,~!$&'()*;")
    return SCHEMES.get(scheme, scheme) + ":" + ("//" if not rest.startswith("//") else "") + quote(rest, safe="/:@=+,~!$&'()*;")


def open_store(path: str):
    """(file system, path in it) of a path as Spark names it. Credentials are those of the task's environment."""
    import pyarrow as pa
    import pyarrow.fs as pafs

    uri = arrow_uri(path)
    try:
        return pafs.FileSystem.from_uri(uri)
    except pa.ArrowInvalid as e:
        raise ValueError(f"{path}: tasks can't open files of this store") from e
