"""Sensitive values inside payloads, by the values that must not be seen."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.privacy import REDACTED, redact_payload


def redacted(spark, texts, custom=()):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(redact_payload(F.col("t"), custom)).collect()]


def test_values(spark):
    cases = {
        r'{"password":"ab\"cd","token":12345}': {"password": REDACTED, "token": REDACTED},
        '{"x_Secret_y" : "v", "n": 1}': {"x_Secret_y": REDACTED, "n": 1},
        '{"auth": true, "cpf": -1.5e3, "apikey": false}': {"auth": REDACTED, "cpf": REDACTED, "apikey": REDACTED},
        '{"tokens": ["a]", 1, "b"], "credential": {"user": "u", "password": "p"}}': {"tokens": REDACTED, "credential": {"user": "u", "password": REDACTED}},
        '{"secret": null, "password": ""}': {"secret": None, "password": ""},
        '{"nick": "n", "nickname": "m", "NICK": 2}': {"nick": REDACTED, "nickname": "m", "NICK": REDACTED},
        r'{"note": "say \"token\": \"v\"", "b": "password"}': {"note": 'say "token": "v"', "b": "password"},
    }
    assert [json.loads(t) for t in redacted(spark, cases, ["nick"])] == list(cases.values())
    assert redacted(spark, [None, "", "no json, token: x"]) == [None, "", "no json, token: x"]


def test_long_strings_take_no_stack(spark):
    long = "z" * 300_000 + r"\"" + "y" * 300_000
    out = redacted(spark, ['{"k":"' + long + '","token":"' + long + '"}'])[0]
    assert out == '{"k":"' + long + f'","token":"{REDACTED}"}}'


VALUES = st.one_of(st.text(max_size=8).filter(bool), st.integers(), st.booleans(), st.floats(allow_nan=False, allow_infinity=False))
KEYS = st.sampled_from(["password", "my_token", "API_KEY", "name", "n", 'q"uote', "authority", "x\\y", "own"])


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.dictionaries(KEYS, VALUES, min_size=1), min_size=20, max_size=40))
def test_any_object(spark, rows):
    hidden = ("password", "secret", "token", "apikey", "api_key", "auth", "credential", "cpf")
    want = [{k: REDACTED if any(h in k.lower() for h in hidden) or k == "own" else v for k, v in r.items()} for r in rows]
    assert [json.loads(t) for t in redacted(spark, [json.dumps(r, ensure_ascii=False) for r in rows], ["own"])] == want
