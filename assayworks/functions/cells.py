"""Cell rules as columns: blanks, labels, numbers, equality keys, turn numbers."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = "decimal(38,18)"


def trimmed(c: Column) -> Column:
    """Text without white space (Unicode's) at either end."""
    return F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")


def blank(c: Column, kind: T.DataType | None = None) -> Column:
    """Null, not a number, or text of white space only."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return c.isNull()
    return c.isNull() | (trimmed(c) == "")


def label(c: Column) -> Column:
    return F.lower(trimmed(c))


def number(c: Column, name: str) -> Column:
    """An exact number; anything else that is not blank is refused."""
    text = trimmed(c)
    value = text.try_cast(NUMBER)
    return F.when(text.isNull() | (text == ""), F.lit(None).cast(NUMBER)).when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit(f"{name}: not a finite number: "), text)).cast(NUMBER)
    )


def equality_key(c: Column, kind: T.DataType) -> Column:
    """Two cells are the same value if their keys are equal: booleans, numbers and texts each among themselves."""
    if isinstance(kind, T.BooleanType):
        name, value = "bool", c.cast("string")
    elif isinstance(kind, T.NumericType):
        exact = F.regexp_replace(F.regexp_replace(c.try_cast(NUMBER).cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
        name, value = "number", F.coalesce(exact, c.cast("string"))
    else:
        name, value = "text", label(c)
    return F.when(~blank(c, kind), F.concat(F.lit(name + ":"), value))


def turn_number(c: Column, kind: T.DataType) -> Column:
    """A whole number of at least 1, else null; booleans are no numbers."""
    if isinstance(kind, T.BooleanType):
        return F.lit(None).cast("long")
    value = trimmed(c).try_cast(NUMBER)
    return F.when((value >= 1) & (value == F.floor(value)), value.cast("long"))


def normalised(c: Column, rule: str, inverted: bool, name: str, values: Mapping[str, Any] | None = None) -> Column:
    """A source cell by its rule: ``label`` text, a ``numeric`` value or per cent, or the number that a ``map`` has for its text."""
    text = trimmed(c)
    empty = text.isNull() | (text == "")
    if rule == "map":
        known = {str(k).strip().lower(): str(v) for k, v in (values or {}).items()}
        refused = F.raise_error(F.concat(F.lit(f"{name}: no value for "), text)).cast(NUMBER)
        pairs = [x for k, v in known.items() for x in (F.lit(k), F.lit(v).cast(NUMBER))]
        out = F.when(empty, None).otherwise(F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(text)), refused) if pairs else refused)
    elif rule == "label":
        out = F.when(~empty, F.lower(text))
    else:
        per_cent = F.regexp_extract(text, r"^(.*)%$", 1)
        out = F.when(text.endswith("%"), (number(per_cent, name) * F.lit("0.01").cast("decimal(3,2)")).cast(NUMBER)).otherwise(number(c, name))
    if inverted:
        if rule == "label":
            raise ValueError(f"{name}: a label cannot be inverted")
        out = F.when(out.isNull(), None).when(out.isin(0, 1), (1 - out).cast(NUMBER)).otherwise(
            F.raise_error(F.lit(f"{name}: only 0 and 1 can be inverted")).cast(NUMBER)
        )
    return out
