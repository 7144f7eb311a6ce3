"""The last JSON object of a text against reading it from every brace, and its time."""

import json
import random
import time

from assayworks.operators.schema import last_object


def naive(text):
    text = text.rsplit("</think>", 1)[-1]
    reader, found, at = json.JSONDecoder(), None, text.find("{")
    while at >= 0:
        try:
            found, at = reader.raw_decode(text, at)
            at = text.find("{", at)
        except ValueError:
            at = text.find("{", at + 1)
    return found


def test_against_every_brace():
    rng = random.Random(9)
    bits = ["{", "}", '"', "a", ":", ",", "1", " ", '{"a": 1}', '{"b": {"c": [1, {"d": "}"}]}}', "[", "]", "\\", '\\"', "null", "-0.5e3", "\n", '"k":', '{"k":', "{}", "</think>", "é", "01", '"\\u00e9"', "\x01", "NaN", "tru"]
    for _ in range(30_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        got, want = last_object(text), naive(text)
        assert json.dumps(got) == json.dumps(want), repr(text)
    assert last_object(None) is None and last_object("") is None


def test_linear():
    n = 1 << 20
    for text in ("{" * n, "{}" * (n // 2), '{"a":' * (n // 5), '{"' * (n // 2), "}" * n, '{"a": "' * (n // 7), '"{' * (n // 2), "{ " * (n // 2), '{"a": [' * (n // 7) + '{"x": 1}'):
        began = time.process_time()
        last_object(text)
        assert time.process_time() - began < 3, text[:10]  # quadratic time would take minutes
    assert last_object('{"a": [' * 1000 + '{"x": 1}') == {"x": 1}
    assert last_object("x" * n + '{"deep": ' * 100_000 + "1" + "}" * 100_000 + ' {"y": 2} {"z": ' + "9" * 5000 + "}") == {"y": 2}
