"""Turns of an unbounded table of conversations with the turns before each: ``turn_with_history`` on a stream.

A conversation's turns wait in its state until the watermark has passed them; then they come
out in the order of time, each with all turns before it.  So a turn may arrive late by as much as the
watermark allows, and the order of arrival changes nothing.  What is later is dropped by the
watermark and counted nowhere in a history.  A conversation of which nothing was heard for
``idle`` of event time is forgotten; a turn that comes after that begins a new one.

State is two lists a conversation: turns that wait, and turns that came out (the history itself,
which every further turn of the conversation repeats).  Timers in event time wake a conversation
for its next turn due and for its end, one for all turns that came together, not one a turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_TURN = "at long, query_id string, input_query string, output_answer string"
_HISTORY = "array<struct<turn_index: long, input_query: string, output_answer: string>>"
OUTPUT = f"session_id string, query_id string, turn_index long, input_query string, output_answer string, history {_HISTORY}"
#: The state store that keeps lists and timers.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def stores(spark: SparkSession) -> Iterator[None]:
    """The settings of :data:`STORE` for a while."""
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Histories(StatefulProcessor):
    def __init__(self, idle_ms: int):
        self._idle = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", _TURN)
        self._told = handle.getListState("told", "input_query string, output_answer string")
        self._last = handle.getValueState("last", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        """Turns join those that wait; the first of them asks to be woken when the watermark has passed it, and then for the next."""
        first = None
        for part in rows:
            new = list(zip(map(int, part["at"]), part["query_id"], part["input_query"], part["output_answer"], strict=True))
            if not new:
                continue
            self._waiting.appendList(new)
            least = min(x[0] for x in new)
            first = least if first is None else min(first, least)
        if first is not None:
            self._handle.registerTimer(first)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """What the watermark has passed comes out in order; after ``idle`` without a turn the conversation goes."""
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(tuple(x) for x in self._waiting.get()) if self._waiting.exists() else []
        due, rest = [x for x in waiting if x[0] <= passed], [x for x in waiting if x[0] > passed]
        told = [tuple(x) for x in self._told.get()] if self._told.exists() else []
        last = self._last.get()[0] if self._last.exists() else None
        out, fresh = [], []
        for at, ident, asked, answered in due:
            if last is not None and at - last > self._idle:
                told, fresh = [], []
                self._told.clear()
            turns = told + fresh
            history = [{"turn_index": i + 1, "input_query": q, "output_answer": a} for i, (q, a) in enumerate(turns)]
            out.append((key[0], ident, len(turns) + 1, asked, answered, history))
            fresh.append((asked, answered))
            last = at
        if due:
            self._told.appendList(fresh)
            self._last.update((last,))
            self._waiting.put(rest) if rest else self._waiting.clear()
            if rest:
                self._handle.registerTimer(rest[0][0])
            self._handle.registerTimer(last + self._idle + 1)
        elif not rest and last is not None and passed > last + self._idle:
            self._told.clear()
            self._last.clear()
        if out:
            yield pd.DataFrame(out, columns=["session_id", "query_id", "turn_index", "input_query", "output_answer", "history"])

    def close(self) -> None:
        pass


def with_history(turns: DataFrame, time: str, late: str = "10 minutes", idle_seconds: int = 86_400) -> DataFrame:
    """``session_id, query_id, turn_index, input_query, output_answer, history`` of ``turns`` with a time, in append mode.

    Turns are numbered from 1 in each conversation by time, equal times by query id.  Null texts are empty; rows
    without a session or a time are left out.  The session needs the settings of :data:`STORE` (see :func:`stores`).
    """
    named = turns.select(
        F.col("session_id").cast("string").alias("session_id"), F.col(time).alias("_time"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("query_id", "input_query", "output_answer")),
    )
    known = named.where("session_id is not null and _time is not null").withWatermark("_time", late).withColumn("at", F.unix_millis(F.col("_time").cast("timestamp")))
    schema = T._parse_datatype_string(OUTPUT)
    return known.groupBy("session_id").transformWithStateInPandas(Histories(idle_seconds * 1000), schema, "Append", "EventTime")


def histories(turns: DataFrame, time: str, idle_seconds: int = 86_400) -> DataFrame:
    """The same of a bounded table, by windows."""
    from pyspark.sql import Window as W

    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("query_id", "input_query", "output_answer")]
    known = turns.select(F.col("session_id").cast("string").alias("session_id"), F.unix_millis(F.col(time).cast("timestamp")).alias("at"), *texts)
    known = known.where("session_id is not null and at is not null")
    order = W.partitionBy("session_id").orderBy("at", "query_id", "input_query", "output_answer")
    begins = F.coalesce(F.col("at") - F.lag("at").over(order) > idle_seconds * 1000, F.lit(False)).cast("int")
    parts = known.withColumn("_part", begins).withColumn("_part", F.sum("_part").over(order.rowsBetween(W.unboundedPreceding, 0)))
    own = W.partitionBy("session_id", "_part").orderBy("at", "query_id", "input_query", "output_answer")
    numbered = parts.withColumn("turn_index", F.row_number().over(own).cast("long"))
    before = F.collect_list(F.struct("turn_index", "input_query", "output_answer")).over(own.rowsBetween(W.unboundedPreceding, -1))
    return numbered.select("session_id", "query_id", "turn_index", "input_query", "output_answer", before.alias("history"))
