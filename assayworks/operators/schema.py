"""Closed answer scales: inferred from labels, described to a judge, and used to read its answers."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayworks.operators.contract import ContractError

#: How many values a scale lists at most, in its strict and in its plain form.
MOST_STRICT, MOST_PLAIN = 10, 50
_JSON_KINDS = {"long": "integer", "double": "number", "boolean": "boolean", "string": "string"}


@dataclass(frozen=True)
class Scale:
    name: str
    kind: str
    #: None: too many values to list, any value of the kind goes.
    values: tuple | None
    nullable: bool
    #: Values are described and answered as text, and read back as they were.
    as_labels: bool = False
    description: str = ""

    def labels(self) -> dict[str, Any]:
        """Texts of the values, and the values; two values that read alike are refused."""
        texts = [str(v) for v in self.values or ()]
        if len(set(texts)) != len(texts):
            raise ContractError(f"{self.name}: labels that read alike: {sorted(texts)}")
        return dict(zip(texts, self.values or (), strict=True))

    def read(self, value: Any) -> Any:
        """A value of an answer as one of the scale; raises :class:`ContractError`."""
        if value is None:
            if self.nullable:
                return None
            raise ContractError(f"{self.name}: a value is missing")
        if self.values is not None and self.as_labels:
            known = self.labels()
            if str(value) not in known:
                raise ContractError(f"{self.name}: {value!r} is none of {sorted(known)}")
            return known[str(value)]
        value = _of_kind(value, self.kind, self.name)
        if self.values is not None and value not in self.values:
            raise ContractError(f"{self.name}: {value!r} is none of {list(self.values)}")
        return value

    def schema(self) -> dict[str, Any]:
        """The JSON schema of the field."""
        out: dict[str, Any] = {"type": _JSON_KINDS[self.kind]}
        if self.values is not None:
            out = {"type": "string", "enum": list(self.labels())} if self.as_labels else {**out, "enum": list(self.values)}
        if self.nullable:
            out = {"anyOf": [out, {"type": "null"}], "default": None}
        return {**out, "description": self.description or f"Value of {self.name}"}


def _of_kind(value: Any, kind: str, name: str) -> Any:
    """A JSON value as a kind: whole numbers are integers, integers are numbers; numbers in text count."""
    if kind == "boolean":
        found = {True: True, False: False, "true": True, "false": False}.get(value) if isinstance(value, (bool, str)) else None
    elif kind == "string":
        found = value if isinstance(value, str) else None
    else:
        try:
            number = None if isinstance(value, bool) else float(value)
        except (TypeError, ValueError):
            number = None
        if number is not None and not math.isfinite(number):
            number = None
        found = number if kind == "double" else int(number) if number is not None and number == int(number) else None
    if found is None:
        raise ContractError(f"{name}: {value!r} is no {kind}")
    return found


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, T.IntegralType):
        return "long"
    return "double" if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)) else "string"


def _seen(df: DataFrame, most: int) -> DataFrame:
    """``name, value, full, gap, part``: a few values of each column, whether it has any, has gaps, and has fractions.

    A task keeps a set of at most ``most + 1`` values a column, as text, and puts out no more; of the
    tasks' values as many a column stay.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, set[str]] = {}
        gaps, parts = set(), set()
        for b in batches:
            for name, column in zip(b.schema.names, b.columns, strict=True):
                held = sets.setdefault(name, set())
                if column.null_count:
                    gaps.add(name)
                if pa.types.is_floating(column.type) and name not in parts and any(x is not None and not x.is_integer() for x in column.to_pylist()):
                    parts.add(name)
                if len(held) <= most:
                    for x in column.unique().drop_null().to_pylist():
                        held.add(repr(x) if isinstance(x, (bool, int, float)) else str(x))
                        if len(held) > most:
                            break
        rows = [(n, v, n in gaps, n in parts) for n, held in sets.items() for v in (held or {None})]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.bool_(), pa.bool_()))], names=["name", "value", "gap", "part"]
        )

    found = df.mapInArrow(keep, "name string, value string, gap boolean, part boolean")
    each = found.groupBy("name", "value").agg(F.max("gap").alias("gap"), F.max("part").alias("part"))
    flags = each.select("name", "value", F.max("gap").over(W.partitionBy("name")).alias("gap"), F.max("part").over(W.partitionBy("name")).alias("part"))
    order = W.partitionBy("name").orderBy(F.col("value").isNull(), "value")
    return flags.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most + 1).drop("_r")


def infer_scales(df: DataFrame, columns: list[str], most: int = MOST_PLAIN, as_labels: bool = False, descriptions: dict[str, str] | None = None) -> list[Scale]:
    """The scale of each column, in one job for all: its distinct values, if there are 1 to ``most``.

    Doubles with gaps that are all whole are integers.
    """
    for c in columns:
        if c not in df.columns:
            raise ContractError(f"column {c} is missing")
    kinds = {c: _kind(df.schema[c].dataType) for c in columns}
    plain = {"boolean": "boolean", "long": "long", "double": "double", "string": "string"}
    rows = _seen(df.select(*(F.col(f"`{c}`").cast(plain[kinds[c]]).alias(c) for c in columns)), most).collect() if columns else []  # most + 1 rows a column
    out = []
    for c in columns:
        own = [r for r in rows if r["name"] == c]
        kind, gap = kinds[c], any(r["gap"] for r in own)
        if kind == "double" and gap and any(r["value"] is not None for r in own) and not any(r["part"] for r in own):
            kind = "long"
        read = {"boolean": lambda v: v == "True", "long": lambda v: int(float(v)) if "." in v or "e" in v else int(v), "double": float, "string": str}[kind]
        values = sorted({read(r["value"]) for r in own if r["value"] is not None})
        scale = Scale(c, kind, tuple(values) if 1 <= len(values) <= most else None, gap, as_labels, (descriptions or {}).get(c, ""))
        if as_labels:
            scale.labels()
        out.append(scale)
    return out


def infer_scale(df: DataFrame, column: str, most: int = MOST_PLAIN, as_labels: bool = False, description: str = "") -> Scale:
    """:func:`infer_scales` of one column."""
    return infer_scales(df, [column], most, as_labels, {column: description})[0]


def strict_scales(df: DataFrame, columns: list[str]) -> list[Scale]:
    """Scales of up to ten values, answered as they are."""
    return infer_scales(df, columns, MOST_STRICT)


def labelled_scales(df: DataFrame, columns: list[str], descriptions: dict[str, str] | None = None) -> list[Scale]:
    """Scales of up to fifty values, described and answered as text and read back as the values."""
    return infer_scales(df, columns, MOST_PLAIN, True, descriptions)


def json_schema(scales: list[Scale], title: str = "Assessment") -> dict[str, Any]:
    """The JSON schema of an answer."""
    needed = [s.name for s in scales if not s.nullable]
    return {"title": title, "type": "object", "properties": {s.name: s.schema() for s in scales}, "required": needed}


def read_answer(answer: dict[str, Any], scales: list[Scale]) -> dict[str, Any]:
    """The fields of an answer on their scales, flat or under ``answer``; raises :class:`ContractError`.

    An object that has none of the fields but describes fields is a schema that was sent back, which is said by name.
    """
    fields = answer["answer"] if "answer" in answer else answer
    if not isinstance(fields, dict):
        raise ContractError(f"an answer holds fields, not a {type(fields).__name__}")
    known = [s.name for s in scales if s.name in fields]
    if not known and isinstance(fields.get("properties"), dict):
        raise ContractError("this describes an answer and is none")
    return {s.name: s.read(fields.get(s.name)) for s in scales}


def validate_answer(answer: dict[str, Any], scales: list[Scale]) -> tuple[bool, list[str]]:
    """Whether an answer is on the scales, and what is wrong with each field."""
    wrong = []
    for part in ([s] for s in scales):
        try:
            read_answer(answer, part if "properties" not in answer else scales)
        except ContractError as e:
            wrong.append(str(e))
    return not wrong, wrong


def parse_answers(raw: Column, scales: list[Scale]) -> list[Column]:
    """``agent_<name>`` for each scale from JSON, flat or under ``answer``; what is off the scale is null."""
    out = []
    for s in scales:
        text = F.coalesce(F.get_json_object(raw, f"$.answer['{s.name}']"), F.get_json_object(raw, f"$['{s.name}']"))
        if s.as_labels and s.values is not None:
            known = {t: v for k, v in s.labels().items() for t in (k, v if isinstance(v, str) else json.dumps(v))}
            pairs = [F.lit(x) for k, v in known.items() for x in (k, v)]
            value = F.try_element_at(F.create_map(*pairs), text)
        else:
            value = text.try_cast(s.kind)
            if s.values is not None:
                value = F.when(value.isin(*s.values), value)
        out.append(value.alias(f"agent_{s.name}"))
    return out


@F.arrow_udf(T.StringType())
def last_json_object(texts: pa.Array) -> pa.Array:
    """The last JSON object at the top level of a text, after any thoughts; null if there is none."""
    return pa.array([None if (found := last_object(t.as_py())) is None else json.dumps(found, ensure_ascii=False, sort_keys=True) for t in texts], pa.string())


#: Where an object may begin, and one token of JSON: a string, another scalar, or a mark.
_BEGIN = re.compile(r'\{(?=[ \t\n\r]*+["}])')
_TOKEN = re.compile(
    r'[ \t\n\r]*+(?:("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+")'
    r"|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null|NaN|-?Infinity)|([{}\[\],:]))"
)
#: What may come next inside an object or array.
_KEY_OR_END, _KEY, _COLON, _VALUE, _VALUE_OR_END, _MORE = range(6)


def _scan(text: str, begin: int, ended: dict[int, int], failed: set[int]) -> None:
    """Read an object from a brace: notes where it and each object in it end, or that they don't.

    What is wrong is wrong for all objects that are open there, so none of them is read again.
    """
    opened, kinds, state, at = [begin], ["{"], _KEY_OR_END, begin + 1
    while opened:
        m = _TOKEN.match(text, at)
        mark = m and m[3]
        if m is None:
            break
        at = m.end()
        if mark in ("}", "]"):
            if kinds[-1] != {"}": "{", "]": "["}[mark] or state not in (_MORE, _KEY_OR_END if mark == "}" else _VALUE_OR_END):
                break
            kinds.pop()
            first = opened.pop()
            if mark == "}":
                ended[first] = at
            state = _MORE
        elif state in (_KEY, _KEY_OR_END):
            if m[1] is None:
                break
            state = _COLON
        elif state == _COLON:
            if mark != ":":
                break
            state = _VALUE
        elif state in (_VALUE, _VALUE_OR_END):
            if mark in ("{", "["):
                opened.append(at - 1)
                kinds.append(mark)
                state = _KEY_OR_END if mark == "{" else _VALUE_OR_END
            elif mark is None:
                state = _MORE
            else:
                break
        elif mark == ",":
            state = _KEY if kinds[-1] == "{" else _VALUE
        else:
            break
    failed.update(opened)


def last_object(text: str | None) -> dict[str, Any] | None:
    """The last JSON object of a text after any thoughts: objects are looked for from the left, one after the end of another.

    A single scan: braces that begin nothing are passed over, and an object that was read as part of one
    that broke off isn't read again, so time is linear in the text.
    """
    if text is None:
        return None
    text = text.rsplit("</think>", 1)[-1]
    ended: dict[int, int] = {}
    failed: set[int] = set()
    found: list[tuple[int, int]] = []
    at = 0
    for m in _BEGIN.finditer(text):
        begin = m.start()
        if begin < at:
            continue
        if begin not in ended and begin not in failed:
            _scan(text, begin, ended, failed)
        if begin in ended:
            at = ended[begin]
            found.append((begin, at))
    for begin, end in reversed(found):
        try:
            return json.loads(text[begin:end])
        except (ValueError, RecursionError):  # numbers and depths beyond what is read
            continue
    return None
