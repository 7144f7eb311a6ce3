"""Packed dialogues as text: JSON, literals with either quotes, and printed arrays.

One tolerant grammar reads all forms: a value is a list in any brackets, an
``array(...)`` around a list, a string, a number or a word for nothing or a truth
value.  Items are parted by commas, and printed arrays, which may have none, by white
space.  Nothing is evaluated.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<array<string>>"
_TOKEN = re.compile(
    r"""\s*(?:(?P<open>[\[(])|(?P<close>[\])])|(?P<comma>,)|(?P<equals>=)
    |(?P<text>[bBrRuU]{0,2}(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"))
    |(?P<number>[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)
    |(?P<word>[A-Za-z_][\w.]*))""",
    re.X | re.S,
)
_WORDS = {"None": None, "null": None, "nan": None, "NaN": None, "True": "True", "False": "False", "true": "True", "false": "False"}
_ESCAPE = re.compile(r"\\(?:x([0-9a-fA-F]{2})|u([0-9a-fA-F]{4})|U([0-9a-fA-F]{8})|([0-7]{1,3})|(\n)|(.))", re.S)
_NAMED = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "a": "\a", "\\": "\\", "'": "'", '"': '"', "/": "/"}
_ARRAYS = ("array", "np.array", "numpy.array")


class NotASequence(ValueError):
    """A text that holds no list of lists."""


def _unescaped(m: re.Match) -> str:
    code = m[1] or m[2] or m[3]
    if code:
        return chr(int(code, 16))
    if m[4]:
        return chr(int(m[4], 8))
    return "" if m[5] else _NAMED.get(m[6], "\\" + m[6])


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise NotASequence(f"unexpected {text[at : at + 20]!r} at {at}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


def parse(text: str) -> list:
    """The nested lists of a text; raises :class:`NotASequence`."""
    try:
        found = json.loads(text)
    except ValueError:
        found = _parsed(_tokens(text))
    if not isinstance(found, list):
        raise NotASequence("not a list")
    return found


def _parsed(tokens: list[tuple[str, str]]):
    """Read one value, without recursion: lists that are open are a stack."""
    stack: list[dict] = [{"items": [], "close": None, "call": False, "skip": False, "fresh": True}]

    def put(value) -> None:
        top = stack[-1]
        if top["skip"]:
            top["skip"] = False
            return
        if not top["fresh"] and not isinstance(value, list):
            raise NotASequence("items without a comma between them")
        top["items"].append(value)
        top["fresh"] = False

    at = 0
    while at < len(tokens):
        kind, value = tokens[at]
        following = tokens[at + 1][0] if at + 1 < len(tokens) else None
        if kind == "word" and value in _ARRAYS and following == "open":
            stack.append({"items": [], "close": ")", "call": True, "skip": False, "fresh": True})
            at += 1
        elif kind == "word" and following == "equals" and stack[-1]["call"]:
            stack[-1]["skip"] = True  # a named argument, as the kind of an array's items
            at += 1
        elif kind == "word":
            if value not in _WORDS and not stack[-1]["skip"]:
                raise NotASequence(f"unknown word {value!r}")
            put(_WORDS.get(value))
        elif kind == "open":
            stack.append({"items": [], "close": "]" if value == "[" else ")", "call": False, "skip": False, "fresh": True})
        elif kind == "close":
            done = stack.pop()
            if not stack or done["close"] != value:
                raise NotASequence("brackets do not match")
            if done["call"]:
                if len(done["items"]) != 1 or not isinstance(done["items"][0], list):
                    raise NotASequence("an array holds one list")
                put(done["items"][0])
            else:
                put(done["items"])
        elif kind == "comma":
            if stack[-1]["fresh"] and not stack[-1]["call"]:
                raise NotASequence("a comma without an item")
            stack[-1]["fresh"] = True
        elif kind == "text":
            parts = []
            while at < len(tokens) and tokens[at][0] == "text":  # neighbouring strings are one
                raw = tokens[at][1]
                prefix = raw[: min(raw.find("'") % (len(raw) + 1), raw.find('"') % (len(raw) + 1))]
                body = raw[len(prefix) + 1 : -1]
                parts.append(body if "r" in prefix.lower() else _ESCAPE.sub(_unescaped, body))
                at += 1
            put("".join(parts))
            continue
        elif kind == "number":
            put(value)
        else:
            raise NotASequence(f"unexpected {value!r}")
        at += 1
    if len(stack) != 1 or len(stack[0]["items"]) != 1:
        raise NotASequence("not one value")
    return stack[0]["items"][0]


def _cell(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False) if isinstance(value, (list, dict)) else str(value)


def turns(text: str | None) -> list[list[str | None]] | None:
    """A dialogue's turns, cells as text; None of a text that is none."""
    if text is None:
        return None
    try:
        found = parse(text)
    except NotASequence:
        return None
    return [[_cell(c) for c in t] for t in found] if all(isinstance(t, list) for t in found) else None


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _turns(texts: pa.Array) -> pa.Array:
    return pa.array([turns(t.as_py()) for t in texts], pa.list_(pa.list_(pa.string())))


def dialogue(text: Column) -> Column:
    """Turns of a packed dialogue in any of the text forms; a text that is none is refused.

    JSON stays in the engine; only what it can't read goes to Python.
    """
    quick = F.from_json(text, TURNS)
    plain = quick.isNotNull() & ~F.exists(quick, lambda t: t.isNull())
    slow = _turns(F.when(~F.coalesce(plain, F.lit(False)), text))
    refused = F.raise_error(F.concat(F.lit("not a dialogue: "), F.substring(text, 1, 80))).cast(TURNS)
    return F.when(text.isNull(), F.lit(None).cast(TURNS)).when(plain, quick).otherwise(F.coalesce(slow, refused))
