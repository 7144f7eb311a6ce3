"""Votes across assessor columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def assessor_columns(columns: list[str], criterion: str) -> list[str]:
    """``agent_<criterion>`` or ``agent_<number>_<criterion>``, the criterion in full."""
    return [c for c in columns if re.fullmatch(rf"agent_(\d+_)?{re.escape(criterion)}", c)]


def first_mode(values: Column) -> Column:
    """The most frequent non-null value of an array; of equally frequent ones the first met; null of none."""
    full = F.filter(values, lambda v: v.isNotNull())
    ranked = F.transform(
        F.array_distinct(full),
        lambda v: F.struct((-F.size(F.filter(full, lambda w: w == v))).alias("n"), F.array_position(full, v).alias("at"), v.alias("v")),
    )
    return F.get(F.array_sort(ranked), F.lit(0))["v"]


def first_mode_of_maps(values: Column) -> Column:
    """:func:`first_mode` of an array of maps: maps of the same entries in any order are equal; the first met of the mode comes back."""
    full = F.filter(values, lambda v: v.isNotNull())
    keys = F.transform(full, lambda v: F.array_sort(F.map_entries(v)))
    return F.get(full, (F.array_position(keys, first_mode(keys)) - 1).cast("int"))


def add_votes(df: DataFrame, criteria: list[str], scoring: bool = True) -> DataFrame:
    """Add ``agent_<criterion>`` (or ``<criterion>``) with the vote of its assessor columns."""
    new = {}
    for c in criteria:
        found = assessor_columns(df.columns, c)
        if found:
            mode = first_mode_of_maps if isinstance(df.schema[found[0]].dataType, T.MapType) else first_mode
            new[f"agent_{c}" if scoring else c] = mode(F.array(*[F.col(f"`{x}`") for x in found]))
    return df.withColumns(new)


def merged(answers: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Answers beside labels, rows of either side alone left out; infinite numbers become null."""
    held = answers.join(labels, key)
    endless = [f.name for f in held.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return held.withColumns({c: F.when(F.abs(F.col(f"`{c}`")) != float("inf"), F.col(f"`{c}`")) for c in endless})
