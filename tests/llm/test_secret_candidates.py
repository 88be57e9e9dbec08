"""Assignments in the forms in which code and configuration have them."""

import time

import pytest

from millrace.llm.secrets import base_spans, novel_spans

RANDOM = "q8Zx2Lm9Vt4Rk7Bn1Wp6"


def found(text):
    return [text[a:b] for _, a, b in novel_spans(text, base_spans(text))]


@pytest.mark.parametrize(
    "text",
    [
        "export AUTH_KEY=%s",
        'const stripe_private_key = "%s"',
        'let privateKey = "%s";',
        "accessKey: %s",
        'signingKey: "%s"',
        "sessionKey=%s",
        "AWSAccessKey=%s",
        'private_key: str = "%s"',
        'config["signing_key"] = "%s"',
        "hint=see-vault&signing_key=%s",
        "postgres://admin:%s@db.local:5432/app",
        "redis://:%s@cache/0",
        'url = "amqp://worker:%s@queue"',
    ],
)
def test_forms(text):
    assert found(text % RANDOM) == [RANDOM]


def test_other_names_and_guessable_passwords():
    for t in ("const monkey = %s", "keyboardLayout=%s", "monkeyBars: %s"):
        assert found(t % RANDOM) == []
    assert found("postgres://admin:your_password_here1@localhost/db") == [] and found("http://host:8080/a@b") == []


def test_each_assignment_is_found():
    second = "Hd73kQpz0XvMs51LtYwe"
    assert found(f"a_key={RANDOM} and b_key={second}") == [RANDOM, second]


def test_long_runs_end():
    began = time.time()
    for t in ("key=" * 8000, "a=" * 20000, "://" * 20000, "://a:" * 10000, "key " + "x" * 50000):
        found(t)
    assert time.time() - began < 60


@pytest.mark.parametrize("token", ["QQZXPLMNVTRKXBNWPWPF", "qqzxplmnvtrkxbnwpwpf", "q8Zx2Lm9Vt4Rk7B", "830172649501827", "Zq8vXt2Lm9Wr"])
def test_the_measure_alone_judges_assigned_tokens(token):
    """One kind of characters, or as few as twelve of them, are no reason to look away."""
    assert found(f"client_credential = {token}") == [token] and found(f"signingKey: '{token}'") == [token]
    assert found("client_credential = application_json") == [] and found("session representations") == []
