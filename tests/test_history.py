"""Histories on a stream against those of the whole table, over triggers, late turns and a restart."""

import datetime
import random

import pytest

from assayworks.streaming import history

SCHEMA = "session_id string, query_id string, input_query string, output_answer string, ts timestamp"
T0 = datetime.datetime(2024, 1, 1)


def turn(session, minute, k, text="t"):
    return (session, f"{session}-{k}", f"{text} {k}", None if k % 5 == 0 else f"a {k}", T0 + datetime.timedelta(minutes=minute))


@pytest.fixture
def store(spark):
    before = {k: spark.conf.get(k, None) for k in history.STORE}
    [spark.conf.set(k, v) for k, v in history.STORE.items()]
    yield
    [spark.conf.unset(k) if v is None else spark.conf.set(k, v) for k, v in before.items()]


def rows_of(df):
    return sorted((r["session_id"], r["query_id"], r["turn_index"], r["input_query"], r["output_answer"], tuple(map(tuple, r["history"]))) for r in df.collect())


def test_stream_equals_table(spark, store, tmp_path):
    rng = random.Random(3)
    parts = []
    for part in range(3):  # later parts hold turns up to 25 minutes before the latest so far
        lo = 60 * part
        rows = [turn(f"s{rng.randrange(6)}", lo + rng.randrange(0, 60) - (20 if part and rng.random() < 0.3 else 0), 1000 * part + k) for k in range(40)]
        parts.append(rows + [turn("s0", lo + 60, 1000 * part + 99), (None, "x", "x", "x", T0), ("s1", "y", "y", "y", None)])
    parts[0] += [turn("pause", 5, 1), turn("pause", 6, 2)]
    parts[1] += [turn("pause", 110, 3)]  # after more than the idle time: a new conversation
    parts.append([turn("end", 1000, 1)])  # the watermark passes all others
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        stream = history.with_history(spark.readStream.schema(SCHEMA).parquet(str(source)), "ts", "30 minutes", idle_seconds=6000)
        q = stream.writeStream.outputMode("append").option("checkpointLocation", state).format("parquet").trigger(availableNow=True).start(target)
        assert q.awaitTermination(180)
        if q.exception():
            raise q.exception()

    for part in parts:  # each part is a start of its own from the same checkpoint
        run(part)
    run([turn("s0", 100, 7777), turn("end", 2000, 2)])  # the first is too late by far and goes
    got = rows_of(spark.read.parquet(target))
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    want = rows_of(history.histories(whole, "ts", 6000))
    assert got == want and len(got) == 3 * 41 + 4
    pauses = [r for r in got if r[0] == "pause"]
    assert [r[2] for r in pauses] == [1, 2, 1] and not any("7777" in r[1] for r in got)
