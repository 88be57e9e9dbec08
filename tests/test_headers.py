"""Only the first row of a file can be a header."""

import bz2
import gzip

import pytest

from millrace.schema import Field, Schema
from millrace.sources.files import files_with_header, read_delimited
from millrace.streaming.ingest import ingest_new_files, published_rows

TWO = Schema.of(Field("id"), Field("x"))


def got(df):
    return sorted((r.id, r.x) for r in df.collect())


def test_rows_like_the_header_are_data(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,a\nid,b\n2,c\n")
    (tmp_path / "b.csv").write_text("3,d\nid,e\n")
    a, b = str(tmp_path / "a.csv"), str(tmp_path / "b.csv")
    assert got(read_delimited(spark, [a], TWO)) == got(read_delimited(spark, [a], TWO, header="true")) == [("1", "a"), ("2", "c"), ("id", "b")]
    assert got(read_delimited(spark, [str(tmp_path)], TWO)) == [("1", "a"), ("2", "c"), ("3", "d"), ("id", "b"), ("id", "e")]
    assert len(got(read_delimited(spark, [a], TWO, header="false"))) == 4
    with pytest.raises(ValueError, match="no header"):
        read_delimited(spark, [a, b], TWO, header="true")


def test_first_lines_of_all_kinds_of_files(spark, tmp_path):
    (tmp_path / "a b.csv.gz").write_bytes(gzip.compress(b"\n \n Id ;x\n1;a\n"))
    (tmp_path / "c.csv.bz2").write_bytes(bz2.compress(b'"ID";x\n2;b\n'))
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("﻿id;x\n3;c\n")
    headed, plain = files_with_header(spark, [str(tmp_path)], "id", ";", "UTF-8")
    assert [p.rsplit("/", 1)[1] for p in sorted(headed)] == ["a b.csv.gz", "c.csv.bz2", "e.csv"] and plain == []
    assert got(read_delimited(spark, [str(tmp_path)], TWO, sep=";")) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,x\n1,a\nid,b\n2,c\n")
    (tmp_path / "in" / "b.csv").write_text("4,d\n")
    for _ in range(2):
        ingest_new_files(spark, str(tmp_path / "in"), TWO, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert got(published_rows(spark, str(tmp_path / "out"))) == [("1", "a"), ("2", "c"), ("4", "d"), ("id", "b")]


def test_many_files_are_looked_at_by_tasks(spark, tmp_path, monkeypatch):
    """Nothing is opened by the driver: with a header, without, empty, packed, and after blank lines."""
    import bz2
    import gzip

    from millrace.sources import files

    want = []
    for i in range(120):
        text = ["id,x\n%d,a\n", "%d,b\n", "\n\n\ufeff ID ,x\n%d,c\n"][i % 3] % i
        kind = i % 4
        data = text.encode()
        (tmp_path / f"f{i}.csv{['', '.gz', '.bz2', ''][kind]}").write_bytes(gzip.compress(data) if kind == 1 else bz2.compress(data) if kind == 2 else data)
        want.append(str(i))
    (tmp_path / "empty.csv").write_bytes(b"")

    def opened(self, uri, charset):
        raise AssertionError(f"the driver opened {uri}")

    monkeypatch.setattr(files._Heads, "first_line", opened)
    got = files.read_delimited(spark, [str(tmp_path)], Schema.of(Field("id"), Field("x")))
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_lines_beyond_what_tasks_read_are_left_to_the_driver(spark, tmp_path):
    from millrace.sources.files import first_lines

    for i in range(80):
        (tmp_path / f"f{i}").write_text("x" * 100_000 + "\n" if i == 7 else f"line {i}\nmore")
    names = [f"file://{tmp_path}/f{i}" for i in range(80)]
    assert first_lines(spark, names, "UTF-8") == ["x" * 100_000 if i == 7 else f"line {i}" for i in range(80)]
