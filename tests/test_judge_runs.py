"""Judges under quota, the gate, and runs that break off."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from assayworks.operators import gate, judge


def quota_judge(each):
    """A service that takes so many prompts a pause; it counts how often each was sent."""
    sent = {}

    def asked(prompts):
        out = []
        for k, p in enumerate(prompts):
            sent[p] = sent.get(p, 0) + 1
            out.append(f"<{p}>" if k < each else judge.Refused("busy", 0.5))
            if k == each:
                return out + [judge.NotSent()] * (len(prompts) - k - 1)
        return out

    return asked, sent


def test_no_prompt_is_lost_under_quota():
    asked, sent = quota_judge(4)
    slept = []
    got = judge.ask(asked, [str(i) for i in range(32)], sleep=slept.append)
    assert [a for a, _ in got] == [f"<{i}>" for i in range(32)] and set(sent) == {str(i) for i in range(32)}
    assert max(sent.values()) == 2 and slept == [0.5] * 7


def test_attempts_are_of_what_was_sent():
    calls = []

    def never(prompts):
        calls.append(list(prompts))
        return [judge.Refused("busy"), *[judge.NotSent()] * (len(prompts) - 1)]

    slept = []
    got = judge.ask(never, ["a", "b"], attempts=3, sleep=slept.append)
    assert [e for _, e in got] == ["Refused: busy"] * 2 and [c[0] for c in calls] == ["a"] * 3 + ["b"] * 3 and slept == [2, 4, 8, 2, 4]
    assert judge.ask(lambda p: [judge.NotSent()] * len(p), ["a", "b"], sleep=slept.append) == [(None, "JudgeError: nothing was sent")] * 2
    assert judge.ask(lambda p: 1 / 0, ["a"], sleep=slept.append)[0][1].startswith("ZeroDivisionError")
    assert judge.ask(lambda p: ["x"] * 3, ["a"], sleep=slept.append)[0][1].startswith("JudgeError: 3 answers")
    assert [judge.pause_after(n) for n in (1, 2, 5, 6, 9)] == [2, 4, 32, 60, 60] and judge.pause_after(3, 7.5) == 7.5


def test_refusals_of_other_clients():
    class Status(Exception):
        status_code = 429

    assert judge.refusal(Status("x")).pause is None and judge.refusal(RuntimeError("Rate limit reached, retry-after=2.5 s")).pause == 2.5
    assert judge.refusal(RuntimeError("no")) is None and judge.refusal(None) is None and judge.refusal(judge.JudgeError("the text 429")) is None


def test_gate():
    now = [0.0]
    g = gate.Gate(2, 10.0, lambda: now[0])
    a, b = g.take()["lease"], g.take()["lease"]
    assert "wait" in g.take()
    g.give(a)
    c = g.take()["lease"]
    g.give(b, 3.0)
    assert g.take()["wait"] == 3.0  # a pause holds back all
    now[0] = 3.5
    assert "lease" in g.take() and "wait" in g.take()
    now[0] = 11.0  # the lease of a lost task runs out
    assert "lease" in g.take()
    g.give(c)


def test_gate_over_sockets(spark):
    held = gate.opened(spark, 3)
    most, now, lock = [0], [0], threading.Lock()
    with held as key:

        def work():
            for _ in range(5):
                lease = key.take()
                with lock:
                    now[0] += 1
                    most[0] = max(most[0], now[0])
                with lock:
                    now[0] -= 1
                key.give(lease, 0.001)

        threads = [threading.Thread(target=work) for _ in range(8)]
        [t.start() for t in threads]
        [t.join(60) for t in threads]
        with pytest.raises(json.JSONDecodeError):
            gate.Pass(key.host, key.port, "wrong")._say(do="take")
    assert 1 <= most[0] <= 3 and held.gate.pauses == 40


class Counting:
    """Notes each call in a folder, and ends its worker once at one prompt."""

    def __init__(self, folder, fatal):
        self.folder, self.fatal = str(folder), fatal

    def __call__(self, prompts):
        for p in prompts:
            with open(f"{self.folder}/{p}", "a") as f:
                f.write("x")
            if p == self.fatal and not os.path.exists(f"{self.folder}/killed"):
                open(f"{self.folder}/killed", "w").close()
                os._exit(1)
        return [f"<{p}>" for p in prompts]


def test_a_killed_task_asks_little_again(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    units = spark.range(60).select(F.col("id").cast("string").alias("_unit_id"), F.col("id").cast("string").alias("p"))
    asks = Counting(calls, "17")
    with pytest.raises(Exception):  # noqa: B017 a local session allows no second attempt of a task
        judge.judged(units, "p", asks, batch=2, ledger=ledger, waves=3)
    counts = lambda: {p: os.path.getsize(calls / p) for p in os.listdir(calls) if p != "killed"}
    before = counts()
    done = {r["_unit_id"] for r in spark.read.parquet(ledger).collect()} if os.path.exists(ledger) else set()
    got = {r["_unit_id"]: r["answer"] for r in judge.judged(units, "p", asks, batch=2, ledger=ledger, waves=3).collect()}
    assert got == {str(i): f"<{i}>" for i in range(60)}
    after = counts()
    assert all(after[p] == before[p] for p in done)  # nothing in the ledger is asked again
    again = [p for p in after if after[p] > 1]
    assert "17" in again and len(again) <= 4 * 2 and max(after.values()) == 2
    judge.judged(units, "p", asks, batch=2, ledger=ledger).count()
    assert counts() == after


def test_errors_are_asked_by_the_next_run(spark, tmp_path):
    units = spark.createDataFrame([("a", "good"), ("b", "bad"), ("c", None)], "k string, p string").withColumn("_wave", F.lit("clash"))
    ledger = str(tmp_path / "ledger")
    first = judge.judged(units, "p", lambda ps: [RuntimeError("no") if p == "bad" else p + "!" for p in ps], "k", ledger=ledger, delay=0.0)
    assert {r["k"]: (r["answer"], r["error"]) for r in first.collect()} == {"a": ("good!", None), "b": (None, "RuntimeError: no"), "c": ("!", None)}
    second = judge.judged(units, "p", lambda ps: [p + "?" for p in ps], "k", ledger=ledger)
    assert {r["k"]: (r["answer"], r["error"]) for r in second.collect()} == {"a": ("good!", None), "b": ("bad?", None), "c": ("!", None)}
    assert judge.judged(units.where("false"), "p", lambda ps: ps, "k").count() == 0
