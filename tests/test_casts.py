from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import casts


def values(spark, texts, value):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(value(casts.clean(F.col("t")))).collect()]


def test_int64(spark):
    texts = ["42", "-7", "  123  ", "+7", "", "abc", "1.5", "1e3", "9223372036854775807", "9223372036854775808", "\t5\r\n", None, "--1", "٣"]
    assert values(spark, texts, casts.int64) == [42, -7, 123, 7, None, None, None, None, 9223372036854775807, None, 5, None, None, None]


def test_float64(spark):
    texts = ["42.5", "-10.75", "  3.14  ", "", "abc", "1e5", "NaN", "Infinity", "1d", ".5", "5.", "."]
    assert values(spark, texts, casts.float64) == [42.5, -10.75, 3.14, None, None, None, None, None, None, 0.5, 5.0, None]


def test_bool(spark):
    yes, no = ["true", "1", "t", "yes", "Y", " T "], ["false", "0", "f", "no", "N"]
    assert values(spark, [*yes, *no, "maybe", ""], casts.boolean) == [True] * 6 + [False] * 5 + [None] * 2


def test_timestamp(spark):
    at = datetime(2026, 8, 23, 14, 0, 0)
    texts = ["2026-08-23T14:00:00Z", "2026-08-23T16:00:00+02:00", "2026-08-23 14:00:00", "2026-08-23", "2026-08-23T14:00:00,5Z", "", "invalid-date", "2026", "12:30", "2026-08-23T14:00:00", "2026-13-40", "2026-02-30"]
    got = values(spark, texts, lambda t: F.unix_micros(casts.timestamp(t)))
    micros = round(at.replace(tzinfo=UTC).timestamp() * 1e6)
    day = round(datetime(2026, 8, 23, tzinfo=UTC).timestamp() * 1e6)
    assert got == [micros, micros, micros, day, micros + 500_000, None, None, None, None, None, None, None]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_timestamp_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, ["2026-08-23 14:00:00", "2026-08-23"], lambda t: F.unix_seconds(casts.timestamp(t)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1787493600, 1787443200]


def test_decimal(spark):
    texts = ["99.995", "99.994", "-99.995", "0.005", ".5", "100", "invalid", "1.2.3", "1e2", ".", "", "99999999999999999999"]
    want = ["100.00", "99.99", "-100.00", "0.01", "0.50", "100.00", None, None, None, None, None, None]
    assert values(spark, texts, lambda t: casts.decimal(t, 2)) == [w and Decimal(w) for w in want]
    assert values(spark, ["12.3456", "12.34", "12"], lambda t: casts.decimal(t, 2, "fail")) == [None, Decimal("12.34"), Decimal("12.00")]


def test_date_and_json(spark):
    assert [str(v) for v in values(spark, ["2026-08-23", "2026-8-3", "2026-02-30"], casts.date)] == ["2026-08-23", "None", "None"]
    texts = ['{"a":1}', "[1,2]", '"x"', "1", '{"a":1}}{', "1,2", '1],[2', '1,"y":2', "nope", "{"]
    assert [v is not None for v in values(spark, texts, casts.json_text)] == [True] * 4 + [False] * 6
