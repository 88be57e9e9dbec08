"""Records that a reader can't parse become dead letters: batch, whole job, arrays, charsets."""

import json

import pytest

from millrace.operators.validate import Rule, validate
from millrace.plans.ingest import run_ingest
from millrace.schema import Field, Schema
from millrace.sources.files import read_json
from millrace.workspace import shared_folder

LOOSE = Schema.of(Field("a"), Field("b"))
GOOD = ['{"a":1,"b":"x"}', ' {"a":9007199254740993,"b":{"c":[1]}} ', "{}", '{"a":null}', '{"a":"q\\"uo"}', '{"_end":5,"a":3}']
BAD = ['{"a":1..}', "broken{{", '{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":1}]', '{"a":1} tail', "5", "null", '"s"', "[1]", '[{"a":1}]', '{"a":1,}', "{'a':1}"]


@pytest.fixture
def path(tmp_path):
    # blank lines are no records; the mark at the beginning and carriage returns are no part of one
    (tmp_path / "a.jsonl").write_text("\ufeff" + "\r\n".join(x for pair in zip(GOOD + BAD, [""] * 99) for x in pair), encoding="utf-8")
    return str(tmp_path / "a.jsonl")


def test_every_line_is_valid_or_a_dead_letter(spark, path):
    checked = validate(read_json(spark, [path], LOOSE, on_malformed="quarantine"), LOOSE, trim=False)
    assert sorted((r.a or "", r.b or "") for r in checked.valid.collect()) == sorted([("1", "x"), ("9007199254740993", '{"c":[1]}'), ("", ""), ("", ""), ('q"uo', ""), ("3", "")])
    letters = checked.dlq.collect()
    assert sorted(r.raw_payload for r in letters) == sorted(BAD)
    assert {(r.error_message, r.failed_column) for r in letters} == {("malformed record", None)}
    assert all(r._source_file.endswith("a.jsonl") for r in letters)
    events = checked.audit.collect()
    assert len(events) == len(BAD) and {(r.event_type, r.severity, r.rule_name, r.column_name) for r in events} == {("malformed_record", "ERROR", "parse", None)}
    # a query that needs nothing else of a row
    assert checked.tagged.where("_failure IS NOT NULL").count() == len(BAD)


def test_whole_job_counts_them(spark, path):
    out = shared_folder(spark)
    report = run_ingest(read_json(spark, [path], LOOSE, on_malformed="quarantine"), LOOSE, out, [Rule("not_null", "a")])
    assert (report.total_read, report.valid, report.dlq) == (len(GOOD) + len(BAD), len(GOOD), len(BAD))
    assert sorted(r.raw_payload for r in spark.read.json(f"{out}/quarantine/dead_letters").collect()) == sorted(BAD)


def test_fail_fails_whatever_is_asked_for(spark, path):
    for columns in (["a"], ["_source_file"]):
        with pytest.raises(Exception, match="malformed record"):
            read_json(spark, [path], LOOSE).select(*columns).collect()
    with pytest.raises(Exception, match="malformed record"):
        read_json(spark, [path], LOOSE).count()


def test_malformed_array_file(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps([{"a": "1"}, {"a": "2"}]))
    (tmp_path / "bad.json").write_text('[{"a":"3"},')
    checked = validate(read_json(spark, [str(tmp_path)], LOOSE, array=True, on_malformed="quarantine"), LOOSE)
    assert checked.tagged.where("_failure IS NOT NULL").select("_failed_rule").collect() == [("parse",)]
    assert [r.raw_payload for r in checked.dlq.collect()] == ['[{"a":"3"},']


@pytest.mark.parametrize("charset", ["latin1", "windows-1252", "utf-16le"])
def test_charsets(spark, tmp_path, charset):
    (tmp_path / "a").write_bytes('{"a":"é"}\n{"a":"ü\n'.encode(charset))
    rows = read_json(spark, [str(tmp_path / "a")], LOOSE, on_malformed="quarantine", charset=charset).collect()
    assert [(r.a, r._corrupt_record) for r in rows] == [("é", None), (None, '{"a":"ü')]


def test_windows_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes('{"a":"€ ‘é’ Ÿ"}\n'.encode("cp1252"))
    assert read_json(spark, [str(tmp_path / "a")], LOOSE, charset="windows-1252").first().a == "€ ‘é’ Ÿ"


def test_secrets_in_malformed_records(spark, tmp_path):
    (tmp_path / "a").write_text('{"password":"hunter2","a":\n')
    checked = validate(read_json(spark, [str(tmp_path / "a")], LOOSE, on_malformed="quarantine"), LOOSE)
    assert "hunter2" not in checked.dlq.first().raw_payload + checked.audit.first().sample_value


def test_schema_may_have_the_column(spark):
    df = spark.createDataFrame([("x", "text")], "a string, _corrupt_record string")
    schema = Schema.of(Field("a"), Field("_corrupt_record"))
    assert validate(df, schema).valid.select("a", "_corrupt_record").collect() == [("x", "text")]
